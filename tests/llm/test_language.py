import numpy as np
import pandas as pd
import pytest

from shoplens.llm.language import Filters, fit, grams, identify

EN = "the house and the garden with their old trees were quiet in the evening light"
DE = "das haus und der garten mit seinen alten bäumen lagen still im abendlichen licht"
DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def filters(spark):
    rows = [(k, f"{EN} {k}", "en") for k in range(8)] + [(k, f"{DE} {k}", "de") for k in range(8, 14)]
    rows += [(20, None, "en"), (21, EN, None)]
    return fit(spark.createDataFrame(rows, DOCS))


def test_texts_get_the_language_of_their_grams(spark, filters):
    assert filters.languages == ["de", "en"]
    rows = [
        (1, "In the EVENING the trees", "x"), (2, "Still lag der GARTEN", None), (3, None, "en"),
        (4, "", "en"), (5, "12 + 34 !!", "en"), (6, "ЖЖЖЖЖЖЖЖ", "en"),
        (7, f"{EN} " * 20_000 + DE, None),
    ]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "0 as score", "'q' as lang_pred")
    found = {r.doc_id: r for r in identify(docs, filters).collect()}
    predicted = [found[k].lang_pred for k in range(1, 8)]
    assert predicted == ["en", "de", "und", "und", "und", "en", "en"]
    assert found[6].score == 0 and all(0 <= r.score <= 1 for r in found.values())
    assert found[1].lang == "x"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr(
        "*", "crc32(cast(doc_id as string)) % 5 = 0 as held_out"
    )
    found = identify(docs, fit(docs.filter("not held_out"))).filter("held_out").toPandas()
    assert (found["lang_pred"] == found["lang"]).mean() > 0.98


def test_without_labels_everything_is_unknown(spark):
    docs = spark.createDataFrame([(1, EN, None)], DOCS)
    none = fit(docs)
    assert identify(docs, none).first().lang_pred == "und"
    assert identify(docs.limit(0), none).count() == 0


def test_counts_are_corrected_for_false_positives():
    rng = np.random.default_rng(1)
    codes = rng.integers(1, 1 << 32, 2000)
    members = pd.DataFrame({"gram": codes, "language": np.arange(2000) % 2})
    filters = Filters.build(members, ["a", "b"], 0)
    assert filters.counts(codes[::2].astype(np.uint32))[0] == pytest.approx(1000, rel=0.01)
    strangers = rng.integers(1, 1 << 32, 20_000).astype(np.uint32)
    assert filters.counts(strangers).max() < 0.01 * len(strangers)


def test_grams_are_those_of_lower_case_letters():
    assert (grams("A-b") == grams("a b")).all()
    assert len(grams("")) == 0


def test_any_number_of_languages_and_languages_of_one_text(spark):
    rng = np.random.default_rng(7)
    words = {
        f"l{k:03}": ["".join(map(chr, rng.integers(97, 123, 8))) for _ in range(30)] for k in range(150)
    }
    rows = [(lang, " ".join(own)) for lang, own in words.items() for _ in range(3)]
    rows += [("one", "жили были дед да баба"), ("en", EN), ("xx", EN)] + [("en", f"{EN} {DE[:9]}")] * 40
    docs = spark.createDataFrame([(k, t, x) for k, (x, t) in enumerate(rows)], DOCS)
    filters = fit(docs)
    assert len(filters.languages) == 153
    assert all(filters.predict(" ".join(own[5:15]))[0] == lang for lang, own in words.items())
    assert filters.predict("дед да баба жили")[0] == "one"
    assert filters.predict(EN)[0] == "en"
