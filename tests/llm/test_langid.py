"""op11 against Kneser-Ney models written out with dictionaries; held-out accuracy; rejection; edge cases."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from predlake.llm import langid, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string"


def plain_model(texts):
    """{order: {gram: count}} by the definition: raw counts on top, distinct left neighbours below."""
    top = Counter()
    for t in texts:
        low = langid.letters(t)
        if low:
            whole = langid.PAD * (langid.ORDER - 1) + low + " "
            top.update(whole[i:i + langid.ORDER] for i in range(len(whole) - langid.ORDER + 1))
    levels = {langid.ORDER: top}
    for k in range(langid.ORDER - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    return levels


def plain_bits(levels, alphabet, text):
    discount, by_context = {}, defaultdict(dict)
    for k, counts in levels.items():
        n = Counter(counts.values())
        discount[k] = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        for g, c in counts.items():
            by_context[k, g[:-1]][g[-1]] = c
    total = 0.0
    whole = langid.PAD * (langid.ORDER - 1) + text + " "
    for i in range(langid.ORDER - 1, len(whole)):
        p = 1 / alphabet
        for k in range(1, langid.ORDER + 1):
            after = by_context.get((k, whole[i - k + 1:i]))
            if after:
                n = sum(after.values())
                p = max(after.get(whole[i], 0) - discount[k], 0) / n + discount[k] * len(after) / n * p
        total -= math.log2(p)
    return total


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 420 and (lang = 'en' or doc_id < 150)").select("doc_id", "text", "lang").collect()
    return [(r.doc_id, r.text, r.lang) for r in rows]


@pytest.mark.parametrize("per_pass", [langid.ENTRIES_PER_PASS, 20_000])
def test_entropies_equal_plain_models_in_one_pass_and_in_many(spark, small, per_pass):
    learn = spark.createDataFrame([(t, lang) for _, t, lang in small], "text string, lang string")
    models = langid.fit(learn, per_pass)
    assert (models.passes > 2) == (per_pass == 20_000)
    held = {r.text for r in learn.where("pmod(xxhash64(text), 20) = 0 and lang = 'en'").collect()}
    assert held
    levels = {lang: plain_model([t for _, t, x in small if x == lang and t not in held]) for lang in models.langs}
    alphabet = len({g for m in levels.values() for g in m[1]}) + 1
    assert models.alphabet == alphabet
    asked = [t[:150] for _, t, _ in small[:10]] + ["Ω und 漢字, xqzzy", ""]
    for r in langid.entropies(spark.createDataFrame([(t,) for t in asked], "text string"), models).collect():
        low = langid.letters(r.text)
        if low:
            assert r["_positions"] == len(low) + 1
            np.testing.assert_allclose(r["_bits"], [plain_bits(levels[x], alphabet, low) for x in models.langs], rtol=1e-5)
        else:
            assert r["_positions"] == 0


def test_probabilities_sum_to_one(spark, small):
    texts = [t for _, t, lang in small if lang == "en"][:20]
    levels = plain_model(texts)
    models = langid.fit(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"))
    model = langid.arrays(models, 0)[0]
    chars = sorted(levels[1])
    for context in ("the ", "\n\n\n\n", "zqzq", " ord"):
        grams = np.array([[ord(x) for x in context + c] for c in chars + ["漢"]])
        p = 2 ** -langid.bits(grams, model, models.alphabet)
        assert abs(p.sum() - 1) < 0.01  # the rest of the alphabet shares what the held-out texts leave


def test_query_is_right_on_held_out_documents(spark):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_kneser_ney_language"](spark, SF).collect()
    assert len(rows) == len(truth) and {r.doc_id for r in rows} == set(truth)
    held = [r for r in rows if r.held_out and truth[r.doc_id][0] is not None and langid.letters(truth[r.doc_id][1] or "")]
    assert len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_rejection_marks_strange_text_and_keeps_usual_text(spark, small):
    learn = spark.createDataFrame([(t, lang) for _, t, lang in small], "text string, lang string")
    models = langid.fit(learn)
    strange = ["".join(chr(0x4E00 + 37 * i % 5000) for i in range(200)), "xq zzk qj vvx " * 20]
    usual = [t for _, t, _ in small if len(t) > 300][:40]
    got = {r.text: r for r in langid.identify(spark.createDataFrame([(t,) for t in strange + usual], "text string"), models).collect()}
    assert all(got[t].rejected for t in strange)
    assert sum(got[t].rejected for t in usual) <= 4


def test_nulls_empty_repeats_long_and_clashing_columns(spark, small):
    more = [(None, None, "en", "x"), (1, "", "en", "x"), (2, " 12 ½ ²!", "de", "x"), (3, None, None, "x"), (3, None, None, "x"),
            (None, small[0][1], None, "x"), (7, "the and " * 60_000, None, "x")]
    docs = spark.createDataFrame([(i, t, lang, "x") for i, t, lang in small] + more, SCHEMA)
    rows = langid.language_scores(docs).collect()
    assert len(rows) == len(small) + len(more)
    blank = [r for r in rows if not langid.letters(r.text or "")]
    assert len(blank) == 5 and all(r.lang_pred == "und" and r.score == 0 and r.rejected and r.cross_entropy is None for r in blank)
    assert next(r for r in rows if r.doc_id == 7).lang_pred == "en"
    assert langid.language_scores(docs.limit(0)).count() == 0
    nothing = langid.language_scores(docs.select("doc_id", "text").selectExpr("*", "cast(null as string) as lang")).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_equal_entropies_go_to_the_first_language(spark):
    learn = spark.createDataFrame([("abc abd", "b"), ("abc abd", "a")], "text string, lang string")
    got = langid.identify(spark.createDataFrame([("abc",)], "text string"), langid.fit(learn)).first()
    assert got.lang_pred == "a"


def test_letters_are_letters_only():
    assert langid.letters("  Ab1c--É½x_") == "ab c é x"
    assert langid.letters("½ ² 12 _") == ""
