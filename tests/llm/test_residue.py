import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import phrases
from tessella.llm import residue as R
from tessella.llm.fields import FieldModel, fitted

AGENTS = ["La mesa técnica", "El Concejo", "La Secretaría de Ambiente", "La empresa de acueducto"]
ACTS = ["aprobó el estudio de suelos en la zona costera", "revisó la ruta escolar de la vereda alta", "amplió la red de acueducto durante 2019", "declaró que el riesgo se considera moderado"]
TRAPS = [
    "La Ley 404 fija las condiciones de la ronda.", "El manual del visor recuerda que los mapas requieren JavaScript; por eso se entregan también impresos.", "En la audiencia se informó que el portal mostró el aviso «Página no encontrada» durante dos días.",
    "El código del visor se escribe {{capa:rondas}} cuando la capa está vigente.", "La leyenda usa <<alto riesgo>> y <<riesgo medio>> como categorías.", "El conjunto de usos {residencial, comercial, mixto} no cambia.", "Véase el anexo [3] y la nota [sic] del plano.",
    "El texto de ejemplo de la cartilla explica cómo leer un plano de usos.", "__Nota:__ los valores son provisionales y @@ no forma parte del código.", "&lt;p&gt; y <|endoftext|> quedaron en el texto.", "El acceso denegado a la servidumbre generó una queja vecinal.", "EducaciÃ³n y dÃ­as con caracteres daÃ±ados.",
]
#: Wordings that no grammar of the package gives.
FIELDS = ["Elaborado por {{cuenca_alta}} en la fecha indicada.", "Responsable: [NOMBRE DE LA CUENCA]", "Firmado el XX de XXXX de 20XX en la sede", "El costo es de %%COSTO_FINAL%%.", "Se notifica a <insertar destinatario> la decisión.", "This report covers [to be completed].", "Vea ${plazo} y __SUPERVISOR__.",
    "Anexo (por completar: " + "la relación de los predios afectados por la obra y de sus propietarios " * 3 + "en orden)", "O custo é de {{ custo_final }}.", "Sede: #BARRIO_NUEVO#", "Zona [[nombre de la zona]] del plan", "Corte al XX/XX/20XX"]
FILLER = ["Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor.", "Este es un párrafo de muestra.", "Pulse dos veces para modificar el título del recuadro.", "asdf asdf qwer zxcv asdf fghj", "Your own text will stand here.", "texto texto texto texto texto texto", "Insert your subtitle here."]
PAGES = ["Error 404: la página solicitada no existe", "Acceso denegado\nRevise el enlace y regrese a la portada.", "HTTP 502 Bad Gateway. Please try again later.", "Active JavaScript en su navegador para usar este mapa.", "Gestión del riesgo en Alto Queno\nEste portal necesita JavaScript para funcionar.",
    "The server is temporarily overloaded. Try again in a few minutes.", "Não foi possível carregar a página. Tente novamente mais tarde.", "Your session has expired. Please log in again."]
BAD = [*FIELDS, *FILLER]


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(1)
    body = lambda: " ".join(f"{rng.choice(AGENTS)} {rng.choice(ACTS)}." for _ in range(rng.randrange(2, 7)))
    texts = [(body(), False) for _ in range(300)] + [(f"{body()} {x} {body()}", False) for x in TRAPS for _ in range(3)] + [(f"{body()}\n{x}\n{body()}", True) for x in BAD] + [(x, True) for x in (*BAD, *PAGES)]
    texts += [(None, False), ("", False), (" \n ", False), ("ab", False), (body() * 400, False), (body() * 200 + " {{cuenca_alta}} " + body() * 200, True)]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string").withColumn("cell", F.lit(1)).withColumn("is_residue", F.lit("clash"))
    return df, texts, {r["doc_id"]: r for r in R.residue(df, "doc_id", "text").collect()}


def test_residue(judged):
    _, texts, got = judged
    wrong = [(t or "")[:200] for k, (t, bad) in enumerate(texts) if got[k]["is_residue"] != bad]
    assert wrong == [] and len(got) == len(texts)


def test_kinds_are_told_apart(judged):
    _, texts, got = judged
    at = {t: got[k] for k, (t, _) in enumerate(texts)}
    assert all(at[x]["has_field"] for x in FIELDS) and all(at[x]["has_filler"] for x in FILLER) and all(at[x]["is_notice"] for x in PAGES)


def test_no_grammar_gives_the_wordings_of_these_tests():
    given = {s.lower() for g in (*phrases.FILLER, *phrases.NOTICES) for s in phrases.combinations(g)}
    assert not given & {x.lower().rstrip(".") for x in (*FILLER, *PAGES)} and not {f for f in phrases.fields() if any(f in x and len(f) > 8 and f not in phrases.BLANKS and "to be completed" not in f for x in FIELDS)}


def test_fields_of_any_length_and_what_is_none():
    m = FieldModel(fitted())
    for n in (1, 10, 200):
        assert m.score("(por completar: " + " ".join(["dato"] * n) + ")") > 0 and m.score("[NOMBRE" + " LARGO" * n + "]") > 0
    for no in ("{% de avance}", "{{capa:rondas}}", "[INST]", "<|user|>", "<p>", "(por ejemplo, agua)", "siglo XX", "[12]", "«Plan de Agua»", '{"k": 1}', "", "[]"):
        assert m.score(no) < 0


def test_a_saved_model_judges_alike(spark, judged, tmp_path):
    df, _, got = judged
    model = R.fit(df.select("text"))
    R.save_model(spark, model, str(tmp_path / "model"))
    again = {r["doc_id"]: r for r in R.residue(df, "doc_id", "text", R.load_model(spark, str(tmp_path / "model"))).collect()}
    assert again == got


def test_clean_corpus_keeps_columns(judged):
    df, texts, got = judged
    clean = R.without_residue(df, "doc_id", "text")
    assert clean.columns == df.columns and clean.count() == sum(not bad for _, bad in texts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert R.residue(df, "doc_id", "text").collect() == []


def test_scores_do_not_depend_on_neighbours(judged):
    counts = R.phrase_counts()
    scorer = R.Scorer(R.Model(np.stack([R._ratio(x, np.ones(R.CELLS)) for x in counts]), fitted()))
    texts = ["Este es un texto de ejemplo.", "", "x", "La mesa técnica revisó la ruta.", "Acceso denegado"]
    together = np.stack(scorer.judge(texts)).T.tolist()
    assert together == [np.stack(scorer.judge([t]))[:, 0].tolist() for t in texts]


@pytest.mark.parametrize("line, around", [("Este es un texto de ejemplo.", ""), ("Este es un texto de ejemplo.", "La mesa técnica revisó la ruta escolar."), ("Error 404: página no encontrada", "")])
def test_repetition_makes_nothing_natural(spark, line, around):
    rng = random.Random(4)
    body = lambda: " ".join(f"{rng.choice(AGENTS)} {rng.choice(ACTS)}." for _ in range(4))
    rows = [(k, body()) for k in range(200)] + [(k, f"{around}\n{line}\n{around}".strip()) for k in range(200, 300)] + [(300, f"{body()}\nEste es un texto de ejemplo.\n{body()}")]
    got = {r["doc_id"]: r["is_residue"] for r in R.residue(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert got == {k: k >= 200 for k, _ in rows}
