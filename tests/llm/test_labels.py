from __future__ import annotations

import numpy as np
import pytest

from tarnwerk.llm import labels, langid
from tarnwerk.llm.text import sentences

EN = "The forklift backed out of the hall and the driver did not see the people who were on the path. "
ES = "El operario resbaló en el suelo mojado y se hizo daño en la rodilla cuando iba por el pasillo. "
RU = "Оператор поскользнулся на мокром полу и не мог больше работать до конца смены. "
DE = "Der Fahrer hat die Leute auf dem Weg nicht gesehen und ist mit dem Stapler aus der Halle gefahren. "
SCHEMA = "table_name string, record_id string, text string, label string, is_english boolean, place string, locale string, extra int"


@pytest.mark.parametrize("label,want", [("en-US", "en"), ("EN_gb", "en"), ("Deutsch", "de"), ("por", "pt"), (" rus ", "ru"), ("und", None), ("??", None), ("", None), (None, None), ("italian", "other")])
def test_label_code(label, want):
    assert labels.label_code(label) == want


def test_runs_and_wrong_labels(spark):
    rows = [("t", f"ok{i}", x, c, None, "1", "en-US", 0) for i in range(5) for x, c in ((EN, "en"), (ES, "es"), (DE, "de"), (RU, "ru"))]
    rows += [
        ("t", "a", EN * 3, "es", None, "1", "en-US", 0), ("t", "b", ES, None, None, None, None, 0), ("t", "c", EN + ES + "\n" + EN, "en", True, "1", "en-US", 0), ("t", "d", EN, "English", False, "1", "en-US", 0),
        ("t", "e", "Nobody hurt.", None, None, "1", "en-US", 0), ("t", "f", None, None, None, None, None, 0), ("t", "g", "", "en", None, None, None, 0), ("t", "h", DE.upper() * 400, "fr", None, None, None, 0), ("t", "i", "123 456 @@ !!", "und", None, None, None, 0),
    ]
    got = sorted((r.record_id, r.seg_no, r.lang_code) for r in labels.wrong_labels(labels.detect(spark.createDataFrame(rows, SCHEMA))).collect())
    assert got == [("a", 1, "en"), ("b", 1, "es"), ("c", 1, "en"), ("c", 2, "es"), ("c", 3, "en"), ("d", 1, "en"), ("h", 1, "de")]


def test_missing_label_needs_no_certainty(spark):
    rows = [("t", "null", None, None, 1, "es", 0.55, 1, 6), ("t", "filled", "pt", None, 1, "es", 0.55, 1, 6), ("t", "sure", "pt", None, 1, "es", 0.95, 1, 6), ("t", "short", None, None, 1, "es", 0.55, 1, 4)]
    got = labels.wrong_labels(spark.createDataFrame(rows, labels.RUN_SCHEMA)).collect()
    assert sorted(r.record_id for r in got) == ["null", "sure"]


def test_empty_table(spark):
    assert labels.detect(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sentences():
    assert sentences("<p>One two.&nbsp;Three!</p>- four\nDr. Five came. ") == ["One two.", "Three!", "four", "Dr. Five came."]
    assert sentences("") == []


def test_prior_decides_only_doubt(spark):
    counts = spark.createDataFrame([("g0", "1\ten", 0, 50), ("g0", "2\tes", 1, 50), ("g0", "\t", 0, 1), ("g0", "3\ten", 1, 1), ("w", "x", 0, 9)], langid.COUNTS)
    top, places = labels.place_priors(counts)
    places = {r.place: r.prior for r in places.collect()}
    assert places["1"][0] > places["3"][0] > places["2"][0] and len(top) == len(places["1"]) == len(langid.LANGS)
    want = np.ones(len(langid.LANGS))
    want[0], want[1] = 52, 52
    on = (np.array([50, 1, 0, 0, 0, 0]) + labels.SMOOTHING * want / want.sum()) / (51 + labels.SMOOTHING)
    assert np.allclose(places["3"], np.log((np.array([0, 1, 0, 0, 0, 0]) + labels.SMOOTHING * on) / (1 + labels.SMOOTHING)))
