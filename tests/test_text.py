import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.functions import measures as M
from tessella.functions import text as T


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, plain, local",
    [("8.200", 8.2, 8200.0), ("1.234.567", None, 1234567.0), ("93,2", 93.2, 93.2), ("1.234,56", 1234.56, 1234.56), ("1,234.56", 1234.56, 1234.56), ("1,234", 1234.0, 1234.0), ("2018", 2018.0, 2018.0), ("", None, None), (None, None, None), ("x", None, None)],
)
def test_number(spark, text, plain, local):
    assert one(spark, text, lambda c: T.number(c)) == plain
    assert one(spark, text, lambda c: T.number(c, "local")) == local


def test_numbers_have_units_and_skip_years_and_signs(spark):
    found = one(spark, "En 2018 hubo -5 casos, 12% y 5 km² en 1.234 viviendas.", T.numbers)
    assert [(x["value"], x["unit"]) for x in found] == [(5.0, ""), (12.0, "%"), (5.0, "km²"), (1.234, "viviendas")]


def test_numbers_without_a_value_are_left_out(spark):
    assert one(spark, "1.234.567 habitantes", T.numbers) == []


def test_scalars(spark):
    assert one(spark, "", T.token_estimate) == 1 and one(spark, None, T.token_estimate) == 1 and one(spark, "x" * 41, T.token_estimate) == 10
    assert one(spark, "  uno  dos\ttres\n", T.word_count) == 3 and one(spark, None, T.word_count) == 0
    assert one(spark, "  Área: Uso/Suelo  rural ", T.slug) == "área_usosuelo_rural" and one(spark, "!!", T.slug) == "section" and one(spark, None, T.slug) == "section"
    assert one(spark, "Heading 3", T.heading_level) == 3 and one(spark, "Title", T.heading_level) == 1
    assert one(spark, "Título 1", T.is_heading_style) is True and one(spark, "Normal", T.is_heading_style) is False and one(spark, None, T.is_heading_style) is False
    assert one(spark, 'so {"a": {"b": 1}} end', T.json_between_braces) == '{"a": {"b": 1}}' and one(spark, "none", T.json_between_braces) is None
    assert one(spark, "it was Reviewed: yes", T.is_reviewed) is True and one(spark, "no", T.is_reviewed) is False and one(spark, None, T.is_reviewed) is False
    assert one(spark, "a [chunk: x1] b [chunk:y]", T.markers) == ["x1", "y"]
    assert one(spark, "abcdefghij", lambda c: T.last_tokens(c, 2)) == "cdefghij" and one(spark, "abc", lambda c: T.last_tokens(c, 2)) == "abc"


def test_table_rows(spark):
    cells = [["a", "b", "a"], ["1", "2", "3"], ["4"], ["5", "6", "7", "8"]]
    assert one(spark, cells, T.table_rows, "array<array<string>>") == [{"b": "2", "a": "3"}, {"a": "4"}, {"b": "6", "a": "7"}]
    assert one(spark, [["", " "], ["1", "2"]], T.table_rows, "array<array<string>>") == [{"col_0": "1", "col_1": "2"}]


@pytest.mark.parametrize(
    "dimension, text, size",
    [("area", "km²", 100), ("area", "mÂ²", 1e-4), ("area", "HECTÁREAS", 1), ("area", "fanegadas", 0.64), ("area", "miles de ha", 1000), ("money", "billones de pesos", 1e12), ("money", "mill. $", 1e6), ("money", "miles de millones de $", 1e9),
     ("population", "mil hab.", 1000), ("flow", "m³/dia", 1000 / 86400), ("flow", "l s⁻¹", 1), ("share", "%.", 1), ("share", "por cada mil", 0.1), ("share", "proporción (0-1)", 100), ("density", "hab./ha", 100), ("rain", "l/m²", 1),
     ("length", "ml", 1e-3), ("mass", "Ton.", 1), ("energy", "KWH", 1e-3), ("volume", "hm³", 1e6), ("area", "s.u.", None), ("area", "", None), ("length", "ver texto", None), ("area", "habitantes", None)],
)
def test_unit(dimension, text, size):
    found = M.unit(dimension, text)
    assert found is None if size is None else found is not None and found[0] == pytest.approx(size)


def test_temperatures():
    for text, value, celsius in (("°F", 212, 100), ("kelvin", 273.15, 0), ("grados centígrados", 20, 20)):
        a, b = M.unit("temperature", text)
        assert value * a + b == pytest.approx(celsius)


@pytest.mark.parametrize(
    "label, unit, word",
    [("Longitud de vías terciarias 2017: km", 1.0, 1), ("Área total (en miles)", None, 1e3), ("Recaudo [millones de $]", 1e6, 1), ("NBI, en %", 1.0, 1), ("Perímetro urbano (superficie)", None, 1), ("Residuos 2018", None, 1), ("Cobertura (proporción (0-1))", 100.0, 1), ("Consumo - kWh", 1e-3, 1)],
)
def test_label(label, unit, word):
    dimension = {"Lo": "length", "Ár": "area", "Re": "money", "NB": "share", "Pe": "area", "Co": "share"}[label[:2]] if not label.startswith("Consumo") else "energy"
    found, scale = M.label_statement(dimension, label)
    assert (found[0] if found else None) == unit and scale == word


@pytest.mark.parametrize(
    "dimension, value, context, unit",
    [("area", 1519.7, "Según el documento, área total llega a 1.519,7 km². Otra fuente cita 3 ha para una zona vecina.", 100), ("area", 12.0, "El valor fue de 12. La red vial medía 5 km y el parque 3 m².", None), ("population", 3294, "fue 3\xa0294 hab. y más", 1),
     ("share", 38.94, "(Valores en porcentaje) Con corte a 2020, fue 38,94.", 1), ("mass", 11310, "Cifras en kilos. El valor fue de 11 310.", 1e-3), ("money", 5000, "costó $ 5.000 en total", 1), ("density", 231.83, "es 231,83hab. por km2 (2019).", 1), ("area", None, "Unidad: ha. Sin dato.", 1), ("energy", 23.46, "En 2015, X reportó 46 en ello", None)],
)
def test_context(dimension, value, context, unit):
    found = M.context_statement(dimension, value, context)
    assert (found[0] if found else None) == unit


@given(st.floats(0.001, 1e9), st.sampled_from([(".", ","), (",", "."), (" ", ",")]))
def test_readings_hold_what_was_written(value, marks):
    thousands, decimal = marks
    written = f"{value:,.4f}".replace(",", "\0").replace(".", decimal).replace("\0", thousands)
    assert any(abs(x - round(value, 4)) <= 1e-6 * max(1, value) for x in M.readings(written))
