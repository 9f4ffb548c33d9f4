import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessella.functions import measures
from tessella.operators import orphans, units

ENTRIES = "entry_id long, measure_key string, label string, value double, unit string, context string, extracted_at timestamp"
INDICATORS = "indicator_code string, indicator_name string, dimension string, common_unit string"
CATALOGUE = [("AR01", "x", "area", "ha"), ("PO01", "x", "population", "habitantes"), ("DE01", "x", "density", "hab/km²"), ("TE01", "x", "temperature", "°C"), ("DI01", "x", "money", "COP")]


def pairs(spark, rows, extra=()):
    df = spark.createDataFrame([(*r, None) for r in rows], ENTRIES)
    for name in extra:
        df = df.withColumn(name, F.lit("clash"))
    return {tuple(r) for r in units.same_amount_pairs(df, spark.createDataFrame(CATALOGUE, INDICATORS)).collect()}


def test_pairs_small(spark):
    rows = [
        (1, "AR01:T:2020", "Área", 100.0, "ha", None),
        (2, "AR01:T:2020", "Área", 1.0, "km²", None),
        (2, "AR01:T:2020", "Área", 1.0, "km²", None),
        (3, "AR01:T:2020", "Área", 100.2, "has.", None),
        (4, "AR01:T:2020", "Área", 100.0, None, None),
        (5, "AR01:T:2020", "Área", 1.0, "n/d", "El valor fue de 1 km2."),
        (6, "AR01:T:2020", "Área", 2.0, "km²", None),
        (7, None, "Área", 1.0, "km²", None),
        (8, "AR01:T:2020", "Área", None, "km²", None),
        (9, "AR01:T:2021", "Área", 1.0, "km²", None),
        (10, "XX99:T:2020", "Área", 1.0, "km²", None),
        (11, "TE01:T:2020", "Temperatura", 0.0, "°C", None),
        (12, "TE01:T:2020", "Temperatura", 32.0, "°F", None),
        (13, "DI01:T:2020", "Presupuesto (en millones)", 5.0, "$", None),
        (14, "DI01:T:2020", "Presupuesto", 5_000_000.0, "pesos", None),
    ]
    assert pairs(spark, rows, ["factor", "band", "unit_", "stated", "dimension"]) == {(1, 2), (1, 5), (2, 3), (3, 5), (11, 12), (13, 14)}


def test_pairs_of_no_entries(spark):
    assert pairs(spark, []) == set()


@pytest.mark.parametrize(
    "dimension, context, expected",
    [
        ("density", "(Valores en hab. por km2) En 2015, Alguatá reportó 85,57.", 1.0), ("density", "Cifras en hab. por km2. El valor adoptado fue de 25.", 1.0), ("density", "UNIDAD: hab. por ha. El valor fue de 25.", 100.0),
        ("population", "Unidad: mill. hab.. En 2015 hubo más.", 1e6), ("population", "(Valores en mill. hab.) Población total.", 1e6), ("population", "cifras en hab. En 2015 hubo más.", 1.0), ("share", "Unidad: proporción (0-1). En 2021 bajó.", 100.0),
        ("population", "Cifras en hab. por km2. El valor fue de 25.", None), ("area", "Cifras en ha. En km2. Otra cosa.", 1.0), ("area", "Valores en el plano. Otra cosa.", None),
    ],
)
def test_headings_with_abbreviations(dimension, context, expected):
    found = measures.context_statement(dimension, 7.5, context)
    assert (found and found[0]) == expected


def test_pairs_by_a_heading_with_abbreviations(spark):
    rows = [(1, "DE01:T:2020", "Densidad", 85.57, None, "(Valores en hab. por km2) En 2015 subió."), (2, "DE01:T:2020", "Densidad", 0.855709, "hab/ha", None)]
    assert pairs(spark, rows) == {(1, 2)}


def test_pairs_equal_all_pairs_with_a_hot_key(spark):
    rng = random.Random(3)
    spell = {"ha": 1.0, "km²": 100.0, "m2": 1e-4, "acres": 0.40468564224, "fanegadas": 0.64}
    rows, amounts = [], {}
    for k in range(300):
        key = "AR01:HOT:2020" if k % 3 == 0 else f"AR01:T{k % 40}:2020"
        unit = rng.choice(list(spell))
        amount = rng.choice([50.0, 50.1, 50.24, 50.26, 51.0, 80.0]) * rng.choice([1, 1, 1.002])
        value = amount / spell[unit]
        rows.append((k, key, "Área", value, unit, None))
        amounts[k] = (key, value, value * spell[unit])
    expected = set()
    for a in amounts:
        for b in amounts:
            (ka, va, qa), (kb, vb, qb) = amounts[a], amounts[b]
            if a < b and ka == kb and abs(va - vb) > 0.02 * max(va, vb) and abs(qa - qb) <= 0.005 * max(qa, qb):
                expected.add((a, b))
    assert pairs(spark, rows) == expected and len(expected) > 500


def test_amounts_from_identities(spark):
    rows = [
        (1, "PO01:T:2020", "Población", 50_000.0, "hab.", None),
        (2, "AR01:T:2020", "Área", 10_000.0, "ha", None),
        (3, "DE01:T:2020", "Densidad", 5.0, None, None),  # 500 a km², so a ha
        (4, "AR01:T:2020", "Área", 100.0, None, None),  # km²
        (5, "AR01:U:2020", "Área", 100.0, None, None),  # nothing is known
        (6, "AR01:T:2020", "Área", None, "ha", None),
    ]
    got = {r["entry_id"]: r for r in units.amounts(spark.createDataFrame([(*r, None) for r in rows], ENTRIES), spark.createDataFrame(CATALOGUE, INDICATORS)).collect()}
    assert got[3]["amount"] == pytest.approx(500) and got[3]["is_unique"] and not got[3]["stated"]
    assert got[4]["amount"] == pytest.approx(10_000)
    assert got[5]["amount"] is None and not got[5]["is_unique"]
    assert got[6]["amount"] is None and len(got) == 6


def test_different_statements_are_weighed(spark):
    rows = [(1, "AR01:T:2020", "Área", 100.0, "ha", None), (2, "AR01:T:2020", "Área (km²)", 1.0, "ha", None)]
    got = {r["entry_id"]: r for r in units.amounts(spark.createDataFrame([(*r, None) for r in rows], ENTRIES), spark.createDataFrame(CATALOGUE, INDICATORS)).collect()}
    assert got[2]["amount"] == pytest.approx(100)


def amounts(spark, rows):
    rows = [(*r, None) for r in rows]
    return {r["entry_id"]: r for r in units.amounts(spark.createDataFrame(rows, ENTRIES), spark.createDataFrame(CATALOGUE, INDICATORS)).collect()}


def test_refuted_identities_decide_nothing(spark):
    """Where stated densities have nothing to do with population and area, they give no unit away."""
    rng = random.Random(3)
    rows = [(10 * k + n, f"{code}:T{k}:2020", "x", math.exp(rng.uniform(1, 9)), unit, None) for k in range(30) for n, (code, unit) in enumerate((("PO01", "hab"), ("AR01", "ha"), ("DE01", "hab/km2")))]
    rows += [(1001, "PO01:U:2020", "x", 50_000.0, "hab", None), (1002, "AR01:U:2020", "x", 10_000.0, "ha", None), (1003, "DE01:U:2020", "x", 5.0, None, None)]
    assert amounts(spark, rows)[1003]["amount"] is None
    held = [(10 * k + n, f"{code}:T{k}:2020", "x", v, unit, None) for k in range(1, 31) for n, (code, unit, v) in enumerate((("PO01", "hab", 1000.0 * k), ("AR01", "ha", 500.0), ("DE01", "hab/km2", 200.0 * k)))]
    assert amounts(spark, held + rows[-3:])[1003]["amount"] == pytest.approx(500)


def test_what_does_not_change_in_time(spark):
    rows = [(k, f"AR01:T:{2010 + k}", "Área", 4000.0, "ha", None) for k in range(5)] + [(9, "AR01:T:2019", "Área", 40.0, None, None), (10, "AR02:T:2019", "Bosque", 40.0, None, None)]
    got = amounts(spark, rows)
    assert got[9]["amount"] == pytest.approx(4000) and got[10]["amount"] is None


def test_a_stated_amount_of_the_key_beats_its_median(spark):
    """Sources contradict each other; a candidate that meets one of them exactly is taken, near ones are not told apart."""
    rows = [(k, "AR01:T:2020", "Área", v, "ha", None) for k, v in enumerate((1000.0, 1010.0, 2000.0, 99_600.0))] + [(10, "AR01:T:2020", "Área", 10.1, None, None), (11, "AR01:T:2020", "Área", 1000.0, None, None)]
    got = amounts(spark, rows)
    assert got[10]["amount"] == pytest.approx(1010) and got[10]["is_unique"]
    assert got[11]["amount"] is None and not got[11]["is_unique"]  # as ha it meets 1000, as km² also 99 600


def test_conflicting_statements_are_decided_by_residuals_before_pairs(spark):
    """A unit column that contradicts the label: what agrees with the key decides, and the pair is found."""
    rows = [(1, "AR01:T:2020", "Área", 100.0, "ha", None), (2, "AR01:T:2020", "Área (km²)", 1.0, "ha", None), (3, "AR01:T:2020", "Área (ha)", 1_000_000.0, "m2", None), (4, "AR01:U:2020", "Área (ha)", 1.0, "m2", None), (5, "AR01:U:2020", "Área", 1e4, "m2", None), (6, "DI01:T:2020", "Presupuesto (en miles)", 5.0, "millones COP", None), (7, "DI01:T:2020", "Presupuesto", 5e6, "COP", None)]
    assert pairs(spark, rows) == {(1, 2), (1, 3), (4, 5), (6, 7)} | {(2, 3)}


@pytest.mark.parametrize("dimension, value, context, factor", [
    ("area", 120.0, "El valor fue 120" + " " * 100 + "km2 en total", 100.0), ("area", 120.0, "El valor de 120, según el censo y la revisión posterior del plan que hizo la oficina de planeación del municipio, (km²) es firme.", 100.0),
    ("density", 83.0, "Fue de 83 para el conjunto de la zona urbana y la rural con corte a diciembre, expresada en hab/ha.", 100.0), ("area", 120.0, "El valor fue 120. Otra zona (km²) tiene 18 ha.", None), ("area", 120.0, "El valor fue 120 y la zona vecina 18 (km²).", None),
    ("flow", 5.0, "(Valores expresados en " + " " * 60 + "metros cúbicos por segundo) El valor fue 5.", 1e3),
])
def test_contexts_are_read_to_the_end_of_the_clause(dimension, value, context, factor):
    found = measures.context_statement(dimension, value, context)
    assert (found and found[0]) == factor


DAY = datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else DAY + timedelta(hours=hours)


def find(spark, parents, children):
    p = spark.createDataFrame([(k, at(b), at(e)) for k, b, e in parents], "chunk_id string, created_at timestamp, deleted_at timestamp").withColumn("t", F.lit("clash")).withColumn("key", F.lit("clash"))
    c = spark.createDataFrame([(r, keys, at(t)) for r, keys, t in children], "section_id string, source_chunk_ids array<string>, created_at timestamp").withColumn("day", F.lit(1)).withColumn("change", F.lit(1))
    refs = orphans.references(c, "draft_sections", "section_id", "source_chunk_ids", "created_at")
    return sorted((r["record_id"], r["key"]) for r in orphans.orphan_references(p, "chunk_id", "created_at", "deleted_at", refs).collect())


def test_orphans_small(spark):
    parents = [(" A ", 0, 50), ("a", 100, None), ("a", 100, None), ("B", 10, 5), ("C", None, None), ("D", 10, 10)]
    children = [
        ("r0", ["a", "A\t", None, " ", "zz"], 1), ("r1", ["a"], 0), ("r2", ["a"], 50), ("r3", ["a"], 99), ("r4", ["a\n"], 100), ("r5", ["b"], 7), ("r6", ["c"], 7), ("r7", ["a"], None), ("r8", None, 5), ("r9", [], 5), ("r0", ["a", "A\t", None, " ", "zz"], 1), ("s", ["d"], 10), ("u", ["a"], -1),
    ]
    assert find(spark, parents, children) == [("r0", "zz"), ("r2", "a"), ("r3", "a"), ("r5", "b"), ("r6", "c"), ("r7", "a"), ("s", "d"), ("u", "a")]


def test_orphans_of_empty_tables(spark):
    assert find(spark, [], [("r", ["a"], 1)]) == [("r", "a")]
    assert find(spark, [("a", 1, 2)], []) == []


def test_orphans_equal_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    key = lambda: "hot" if rng.random() < 0.35 else f"k{rng.randrange(30)}"
    parents = [(key(), b, b + rng.randrange(1, 60) if rng.random() < 0.7 else None) for b in (rng.randrange(0, 2000) for _ in range(60))]
    children = [(f"r{n}", [key() for _ in range(3)], rng.randrange(0, 2100)) for n in range(400)]
    expected = sorted({(r, k) for r, keys, t in children for k in keys if not any(p == k and b <= t and (e is None or t < e) for p, b, e in parents)})
    assert find(spark, parents, children) == expected and 50 < len(expected) < 1100


def test_orphans_by_period(spark):
    df = spark.createDataFrame([("t", "r1", "a", DAY), ("t", "r1", "b", DAY), ("t", "r2", "a", None)], "table_name string, record_id string, key string, t timestamp")
    assert sorted(map(tuple, orphans.orphans_by_period(df).collect()), key=str) == [("t", "2024-01", 2, 1), ("t", None, 1, 1)]
