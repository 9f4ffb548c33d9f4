import random

import pytest
from pyspark.sql import functions as F

from tessella.llm import truncation as T

AGENTS = ["la mesa técnica", "el concejo", "la junta de vereda", "la oficina de planeación"]
ACTS = ["aprobó el estudio de suelos", "revisó la ruta escolar", "amplió la red de acueducto", "recibió el censo de pozos"]
PLACES = ["en la zona costera", "en la meseta seca", "durante la temporada de lluvias", "por orden del juzgado"]


def sentence(rng):
    return f"{rng.choice(AGENTS)} {rng.choice(ACTS)} {rng.choice(PLACES)}, con apoyo de {rng.randrange(10, 99)} hogares.".capitalize()


def text(rng, n):
    return " ".join(sentence(rng) for _ in range(n))


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(2)
    rows, truth = [], {}

    def add(key, origin, value, cut):
        rows.append(("chunk_summaries", key, origin, value))
        truth[key] = cut

    for k in range(150):
        add(f"w{k}", "clean", text(rng, 4), False)
    for k in range(40):
        add(f"l{k}", "limited", text(rng, 12)[:300], True)
    for k in range(80):
        whole = text(rng, rng.randrange(1, 3))
        add(f"s{k}", "limited", whole, False)
    for k in range(15):
        t = text(rng, 3)
        add(f"p{k}", "clean", t[: t.rindex(" hogares") - 12], True)
        add(f"b{k}", "clean", text(rng, 2) + " La mesa técnica aprobó el est", True)
        add(f"n{k}", "clean", text(rng, 2)[:-1], False)
        add(f"i{k}", "clean", text(rng, 2) + "\n- Pozos: 12 hogares\n- Suelos: 17 hogares", False)
        add(f"j{k}", "clean", text(rng, 2) + "\n- Pozos: 12 hogares\n- Suelos: 17 hogares\n- Aguas: 3 hogares", False)
    add("mark1", "x", "Se revisó el plan [...]", True)
    add("mark2", "x", "Se revisó el pla�", True)
    add("mark3", "x", "Se revisó la propu-", True)
    add("null", "x", None, False)
    add("blank", "x", " \n\t", False)
    add("dots", None, "Y así en cada vereda...", False)
    rows += [r for r in rows if r[1] == "mark1"]
    df = spark.createDataFrame(rows, "table_name string, record_id string, origin string, text string").withColumn("n", F.lit("clash")).withColumn("state", F.lit("clash"))
    df = df.union(spark.createDataFrame([("t", f"d{k}", "y", "Todo sigue igual. Y así en cada vereda...", "", "") for k in range(30)], df.schema))
    return {r["record_id"]: r for r in T.cut_records(df).collect()}, truth


def test_cut_records(judged):
    got, truth = judged
    wrong = {k: cut for k, cut in truth.items() if k in got and got[k]["is_cut"] != cut}
    cut = sum(truth.values())
    limited = [k for k in truth if k.startswith("l") and got[k]["state"] == "closed"]  # the limit may fall on an end
    assert len([k for k in wrong if k not in limited]) <= 0.02 * cut, wrong
    assert "null" not in got and "blank" not in got


def test_repeated_records_count_once(judged):
    got, truth = judged
    assert got["mark1"]["is_cut"] and sum(k == "mark1" for k in got) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "table_name string, record_id string, origin string, text string")
    assert T.cut_records(df).collect() == []


def test_rates(spark):
    df = spark.createDataFrame([("t", "a", True), ("t", "a", False), ("t", None, True)], "table_name string, origin string, is_cut boolean")
    assert sorted(map(tuple, T.cut_rates(df).collect()), key=str) == [("t", "a", 2, 1, 0.5), ("t", None, 1, 1, 1.0)]


@pytest.mark.parametrize(
    "tail, state", [("todo bien.", "closed"), ("¿y qué?", "closed"), ("«fin».", "closed"), ("(sí.)", "closed"), ("sigue...", "dots"), ("sigue…", "dots"), ("corta [...]", "mark"), ("cor�", "mark"), ("regis-", "mark"), ("en 2019.", "stop"), ("figura como n.", "stop"), ("el lote (código 5)", "open"), ("dijo «sí»", "open"), ("...", "dots"), ("---", "closed"), ("en la", "open"), ("en la \n", "open"), ("| a | 3 |", "open")]
)
def test_states(tail, state):
    assert T.read_end(tail)[0] == state


def test_group_hashes_agree():
    import numpy as np

    tokens = T.forms("En 2019 el Concejo de Villa Nueva aprobó 1.234 obras.\nFin")
    own = np.array([T._HASHES[t] for t in tokens], np.uint64)
    assert [int(T.all_group_hashes(own, n)[-1]) for n in T.ORDERS if n <= len(tokens)] == T.group_hashes(tokens)


@pytest.mark.parametrize("value, ended", [("La junta aprobó el plan vi", 0), ("La junta aprobó el plan", None), ("La junta aprobó el plan.", 1), ("La junta aprobó el plan Nacional de Ag", 0)])
def test_an_open_end_ends_no_sentence(value, ended):
    import numpy as np

    tally = T._Tally(np.ones(1 << 16, bool))
    tally.add([*tally.tokens(value), *[T._END] * T.ORDERS[-1]])
    got = {h: (a, b) for hashes, seen, ends in tally.found for h, a, b in zip(hashes.tolist(), seen.tolist(), ends.tolist())}
    assert [got.get(h) for h in T.group_hashes(["aprobó", "el", "plan"])] == [None if ended is None else (1, ended)] * 3


def test_blanks_and_long_rows_at_the_end(spark):
    long = "municipio con acueducto y hogares " * 12
    texts = {"blank": "La junta aprobó el plan vi" + " \n\t\u00a0" * 100, "row": f"Hogares:\n- Pozos: {long}12 hogares", "number": f"Hogares:\n 12. {long}12 hogares", "text": f"Hogares:\nPozos: {long}12 hogares", "one": f"- Pozos: {long}12 hogares", "closed": "La junta aprobó el plan." + " " * 400}
    df = spark.createDataFrame([("t", k, "o", v) for k, v in texts.items()], "table_name string, record_id string, origin string, text string")
    got = {r["record_id"]: (r["state"], r["place"], r["n_chars"]) for r in T.ends(df).collect()}
    want = {"blank": ("open", "text"), "row": ("open", "row"), "number": ("open", "row"), "text": ("open", "text"), "one": ("open", "text"), "closed": ("closed", "text")}
    assert got == {k: (*want[k], len(v)) for k, v in texts.items()}


def test_blanks_long_words_and_long_lines_are_read_whole(spark):
    rng = random.Random(5)
    name = "Villa " + "Santa Rosa del Alto " * 15
    rows = [("t", f"w{k}", "x", text(rng, 5)) for k in range(60)] + [
        ("t", "blanks", "x", text(rng, 2) + " La mesa técnica aprobó el est" + " \n\t" * 4000), ("t", "row", "x", text(rng, 2) + "\n- " + "zona de manejo " * 40 + "costera"),
        ("t", "name", "x", text(rng, 2) + " con apoyo de " + name + "en la zona costera."), ("t", "mark", "x", "Se revisó el plan [" + "." * 60 + "]"), ("t", "word", "x", "x" * 50_000), ("t", "done", "x", text(rng, 2) + " " * 10_000),
    ]
    got = {r["record_id"]: r for r in T.cut_records(spark.createDataFrame(rows, "table_name string, record_id string, origin string, text string")).collect()}
    assert got["blanks"]["is_cut"] and got["mark"]["is_cut"] and not got["name"]["is_cut"] and not got["done"]["is_cut"]
    assert T.read_end(("zona de manejo " * 40).strip(), "- " + "zona de")[3] == "row"


def test_several_limits_of_an_origin_and_a_word_that_some_text_holds(spark):
    rng = random.Random(6)
    rows = [("t", f"w{k}", "o", text(rng, rng.randrange(1, 9))) for k in range(300)] + [("t", f"a{k}", "o", text(rng, 6)[:200]) for k in range(30)] + [("t", f"b{k}", "o", text(rng, 9)[:450]) for k in range(30)]
    rows += [("t", f"z{k}", "q", text(rng, 4)) for k in range(400)] + [("t", "typo", "q", "La acued abc se revisó. " + text(rng, 3)), ("t", "cut", "q", text(rng, 2) + " La mesa técnica amplió la red de acued")]
    df = spark.createDataFrame(rows, "table_name string, record_id string, origin string, text string")
    limits = {r["origin_key"]: r for r in T._limits(T.ends(df)).collect()}
    assert {x["n"] for x in limits["o"]["limits_chars"]} == {200, 450} and "q" not in limits
    got = {r["record_id"]: r for r in T.cut_records(df).collect()}
    assert got["cut"]["is_cut"] and not any(got[f"w{k}"]["is_cut"] for k in range(300))
    assert sum(got[f"{x}{k}"]["is_cut"] or got[f"{x}{k}"]["state"] == "closed" for x in "ab" for k in range(30)) >= 58
