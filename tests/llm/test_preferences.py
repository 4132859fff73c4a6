from pyspark.sql import functions as F

from candlewick.llm import preferences as P
from tests.llm.common import with_extras


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def formatted(spark, chosen, rejected):
    kind = "array<struct<turn:long,role:string,text:string>>"
    df = spark.createDataFrame([([(i, *t) for i, t in enumerate(chosen)], [(i, *t) for i, t in enumerate(rejected)])],
                               f"chosen {kind}, rejected {kind}")
    return P.format_pairs(df).first()


def render(ts):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in ts)


def test_longest_common_prefix_and_masks(spark):
    a = [("system", "s"), ("user", "ü?"), ("assistant", "yes"), ("user", "more"), ("assistant", "fine")]
    for b in (a[:2] + [("assistant", "no")], a[:3], a[1:], a[:4] + [("assistant", "")], [], a):
        r = formatted(spark, a, b)
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert r.prompt_turns == k and r.prompt == render(a[:k])
        for side, ts in (("chosen", a), ("rejected", b)):
            text = r[f"{side}_completion"]
            assert text == render(ts[k:])
            assert [text[s.start:s.end] for s in r[f"{side}_mask"]] == [
                f"{t}<|end|>\n" for role, t in ts[k:] if role == "assistant"]


def test_pairs_of_a_table(spark):
    rows = []
    for c in range(40):      # one hot opening, one repeated conversation, some of their own
        rows += [(c, 0, "user", "hello" if c < 30 else f"own {c}"), (c, 1, "assistant", "x" * (c if c < 25 else 3))]
    rows += [(c, 1, "assistant", "x" * c) for c in range(3)]                 # repeated turn rows
    rows += [(None, 0, "user", "hello"), (70, 0, None, None), (71, None, "assistant", None), (72, 0, "user", "only")]
    out = P.preference_pairs(turns(spark, rows), ring=7).withColumn("n", F.size("chosen_mask")).collect()
    near = [r for r in out if not r.pair_id.startswith("swap:")]
    swap = [r for r in out if r.pair_id.startswith("swap:")]
    # 25 conversations differ, 25..29 equal conversation 3: 12 pairs and one left over
    assert len(near) == 12 and len({i for r in near for i in (r.chosen_id, r.rejected_id)}) == 24
    assert all(r.prompt == render([("user", "hello")]) and len(r.chosen_completion) > len(r.rejected_completion)
               for r in near)
    assert all(r.n == 1 and r.chosen_completion != r.rejected_completion for r in swap)
    assert len({r.chosen_id for r in swap}) == len(swap)
    assert {72, 70}.isdisjoint(r.chosen_id for r in swap)


def test_empty_table(spark):
    assert P.preference_pairs(turns(spark, [])).count() == 0


def test_clashing_columns_and_long_texts(spark):
    long = "word " * 60_000
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", long), (2, 0, "user", "hi"), (2, 1, "assistant", "short"),
            (3, 0, "user", None), (3, 1, None, "x"), (None, 0, "user", "hi")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = with_extras(turns).withColumn("turns", F.lit(1)).withColumn("chosen", F.lit("c")).withColumn("rank", F.lit(2))
    want = sorted(map(tuple, P.preference_pairs(turns).collect()), key=str)
    assert sorted(map(tuple, P.preference_pairs(extra).collect()), key=str) == want and want
    assert any(long in r[5] for r in want)
    t = "array<struct<turn:long,role:string,text:string>>"
    pairs = spark.createDataFrame([("p", "old", [(0, "user", "q"), (1, "assistant", "a")],
                                    [(0, "user", "q"), (1, "assistant", "b")])],
                                  f"pair_id string, prompt string, chosen {t}, rejected {t}")
    out = P.format_pairs(pairs)
    assert out.columns.count("prompt") == 1 and out.first().prompt == "<|user|>\nq<|end|>\n"
