import random

import pytest
from pyspark.sql import functions as F

from tessella.llm import mixing as M


def counted(spark, sizes):
    rows = [(n, s, t) for n, (s, t) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


def targets(spark, rows):
    return spark.createDataFrame(rows, "plan_name string, source string, target_share double, max_repeats int").withColumn("held", F.lit("clash"))


def shares(spark, c, t):
    return {(r["plan_name"], r["source"]): r for r in M.reached_shares(M.mix(c, t), c, t).collect()}


def test_shares_are_reached_within_caps(spark):
    rng = random.Random(1)
    c = counted(spark, [("big", rng.randrange(1, 200)) for _ in range(3000)] + [("small", rng.randrange(1, 200)) for _ in range(100)] + [("mid", rng.randrange(1, 200)) for _ in range(600)])
    t = targets(spark, [("p", "big", 0.5, 1), ("p", "mid", 0.3, 2), ("p", "small", 0.2, 4), ("p", "absent", 0.0, 3)])
    got = shares(spark, c, t)
    for (_, s), share in {("p", "big"): 0.5, ("p", "mid"): 0.3, ("p", "small"): 0.2}.items():
        assert got["p", s]["reached_share"] == pytest.approx(share, abs=0.005) and got["p", s]["most_uses"] <= {"big": 1, "mid": 2, "small": 4}[s]
    assert got["p", "small"]["most_uses"] == 4 and got["p", "absent"]["n_tokens"] == 0


def uniform(c, plan):
    return {r["doc_id"]: (r["u"] + 0.5) / (1 << 52) for r in c.withColumn("u", F.pmod(F.xxhash64(F.lit(1), F.lit(plan), "doc_id"), F.lit(1 << 52))).collect()}


def chances(sizes, rest):
    """Inclusion probabilities by repeated taking out of what reaches 1."""
    certain = set()
    while True:
        left = {k: n for k, n in sizes.items() if k not in certain}
        lam = (rest - sum(sizes[k] for k in certain)) / sum(n * n for n in left.values())
        over = {k for k, n in left.items() if lam * n >= 1}
        if not over:
            return {k: 1.0 if k in certain else lam * n for k, n in sizes.items()}
        certain |= over


@pytest.mark.parametrize("slice_size", [5000, 40])
def test_draw_equals_a_plain_one(spark, monkeypatch, slice_size):
    """The sliced draw takes what sorting whole strata by the Pareto rank takes, and not what sorting by u alone does."""
    monkeypatch.setattr(M, "SLICE", slice_size)
    rng = random.Random(4)
    c = counted(spark, [("a", int(rng.lognormvariate(4, 1)) + 1) for _ in range(2500)] + [("a", 40_000)] + [("b", 5000)] * 20)
    t = targets(spark, [("p", "a", 0.5, 1), ("p", "b", 0.5, 1)])
    rest = next(r["rest"] for r in M.allocation(c, t).collect() if r["source"] == "a")
    sizes = {r["doc_id"]: r["n_tokens"] for r in c.filter("source = 'a'").collect()}
    pi, u = chances(sizes, rest), uniform(c, "p")
    drawn = {r["doc_id"] for r in M.mix(c, t).collect() if r["source"] == "a" and r["n_uses"] == 1}
    certain = {k for k in sizes if pi[k] == 1}
    assert certain and certain <= drawn and abs(len(drawn) - sum(pi.values())) <= 1
    by_u = differs = 0
    for octave in range(20):
        inside = [k for k in sizes if sizes[k].bit_length() - 1 == octave and k not in certain]
        take = len(drawn & set(inside))
        rank = sorted(inside, key=lambda k: (u[k] / (1 - u[k]) / (pi[k] / (1 - pi[k])), k))
        assert set(rank[:take]) == drawn & set(inside)
        assert abs(take - sum(pi[k] for k in inside)) <= 1
        differs += sorted(inside, key=lambda k: u[k])[:take] != rank[:take]
    assert differs > 3


def test_inclusion_rates_are_the_probabilities(spark):
    """Over 500 plans, which draw by numbers of their own."""
    rng = random.Random(7)
    sizes = [rng.choice([10, 15, 25, 60, 90, 200, 700]) for _ in range(120)]
    c = counted(spark, [("a", n) for n in sizes] + [("b", 10_000)])
    t = targets(spark, [(f"p{k}", s, share, 1) for k in range(500) for s, share in (("a", 0.4), ("b", 0.6))])
    rest = M.allocation(c, t).filter("source = 'a' and plan_name = 'p1'").first()["rest"]
    pi = chances(dict(enumerate(sizes)), rest)
    seen = {r["doc_id"]: r["n"] for r in M.mix(c, t).filter("source = 'a'").groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for n in set(sizes):
        own = [k for k in pi if sizes[k] == n]
        rate, p = sum(seen.get(k, 0) for k in own) / 500 / len(own), pi[own[0]]
        assert abs(rate - p) < 4 * (max(p * (1 - p), 1e-4) / 500 / len(own)) ** 0.5 + 0.01, (n, rate, p)


def test_missing_sources_and_no_caps(spark):
    c = counted(spark, [("a", 10)] * 10 + [("b", 10)] * 10)
    got = shares(spark, c, targets(spark, [("p", "a", 0.5, None), ("p", "b", 0.25, None), ("p", "gone", 0.25, 2), ("q", "gone", 1.0, None), ("r", "a", None, 1), ("r", "b", 1.0, 0)]))
    assert got["p", "a"]["reached_share"] == pytest.approx(2 / 3, abs=0.03) and got["p", "gone"]["n_uses"] == 0
    assert got["q", "gone"]["reached_share"] == 0 and got["r", "b"]["n_tokens"] == 0 and got["r", "a"]["n_tokens"] == 0


def test_again_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a", "uno dos"), (1, "a", "uno dos"), (2, "a", None), (3, "a", ""), (None, "a", "x"), (4, None, "x"), (5, "b", "tres")], "doc_id long, source string, text string").withColumn("n_tokens", F.lit("clash"))
    c = M.counted_documents(docs)
    assert {r["doc_id"] for r in c.collect()} == {1, 5}
    t = targets(spark, [("p", "a", 0.5, 5), ("p", "a", 0.5, 5), ("p", "b", 0.5, 5), (None, "a", 0.5, 1)])
    assert sorted(map(tuple, M.mix(c, t).collect())) == sorted(map(tuple, M.mix(c, t).collect())) != []


def test_empty_tables(spark):
    c, t = counted(spark, [("a", 1)]), targets(spark, [("p", "a", 1.0, 1)])
    assert M.mix(c.limit(0), t).collect() == [] and M.mix(c, t.limit(0)).collect() == []
