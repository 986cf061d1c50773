"""op1 and op4: held-out accuracy, contract columns and edge cases."""

import random
import zlib

import numpy as np
import pytest

from predlake.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score string, held_out string, lang string"
LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.mark.parametrize("name,label,modulus,rest,least", [
    ("op1_knn_quality", "quality", 5, 0, 0.95), ("op4_levenshtein_toxicity", "toxic", 3, 1, 0.9)])
def test_query_accuracy_on_held_out(spark, name, label, modulus, rest, least):
    rows = queries.QUERIES[name](spark, SF).collect()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    cut = 0.3 if label == "quality" else 0.7
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) for r in rows)
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and np.mean(held) >= least


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeinrstlod") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(20, 60))) for _ in range(n)]


def test_quality_without_labels_and_with_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, "s", "h", "en"), (1, None, "s", "h", "en"), (None, "", "s", "h", None), (2, "word " * 30_000, "s", "h", "en")], DOCS)
    got = quality.quality_scores(rows, spark.createDataFrame([], LABELS))
    assert got.columns == ["doc_id", "text", "score", "held_out", "lang", "predicted"]
    assert [(r.score, r.predicted) for r in got.collect()] == [(1.0, 1)] * 4
    assert quality.quality_scores(rows.limit(0), spark.createDataFrame([(1, 1, 0, "")], LABELS)).count() == 0


def test_quality_separates_repeats_and_signs(spark):
    texts = corpus(400)
    bad = [i % 4 == 0 for i in range(400)]
    texts = [" ".join(f"{w} " * 6 for w in t.split()[:12]) if b and i % 8 else " | ".join(t.split()) if b else t for i, (t, b) in enumerate(zip(texts, bad))]
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], DOCS)
    labels = spark.createDataFrame([(i, int(not b), 0, "") for i, b in enumerate(bad)] + [(None, 1, 0, ""), (7, None, 0, ""), (9999, 1, 1, "")], LABELS)
    held = [(r.predicted, int(not bad[r.doc_id])) for r in quality.quality_scores(docs, labels).collect() if r.held_out]
    assert len(held) > 40 and np.mean([p == y for p, y in held]) >= 0.97


def test_vote_equals_a_plain_vote():
    texts = corpus(60, 9)
    y = np.array([i % 3 > 0 for i in range(60)], float)
    model = quality.fit([quality.compressed(quality.terms(t)) for t in texts], y)
    asked = [" ".join(t.split()[:9]) for t in texts[:20]] + [""]
    got = quality.vote([quality.terms(t) for t in asked], model)
    for t, p in zip(asked, got):
        c = np.zeros(quality.TERMS)
        at, n = quality.terms(t)
        c[at] = (1 + np.log(n)) * model["idf"][at] if len(at) else 0
        v = c @ model["basis"]
        near = sorted(((float(v @ x) / max(np.linalg.norm(v), 1e-12), -k) for k, x in enumerate(model["vectors"])), reverse=True)[:quality.NEIGHBOURS]
        w = [max(s, 0) ** quality.SHARPNESS for s, _ in near]
        want = sum(a * y[-k] for a, (_, k) in zip(w, near)) / sum(w) if sum(w) else y.mean()
        assert abs(p - want) < 1e-3


def test_terms_tell_scripts_and_words_apart():
    def vector(text):
        c = np.zeros(quality.TERMS)
        at, n = quality.terms(text)
        c[at] = n
        return c
    assert (vector("мама мыла раму") != vector("папа пилу дали")).any() and (vector("ABC DEF") != vector("XYZ QRS")).any()
    assert vector("a a b b b")[quality.REPEATED] == 3 and vector("a a b b b")[quality.REPEATED + 1] == 1
    plain = quality.terms("one two  three\none 漢字")
    assert plain[1].sum() == sum([19 - 1 + 2, 19 - 2 + 2, 5]) and len(quality.terms("")[0]) == 0 and quality.terms("x")[1].sum() == 1


def test_repeated_rows_of_a_labelled_id_do_not_reach_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "same text of one id", "", "", "")] * 500 + [(2 + i, t, "", "", "") for i, t in enumerate(corpus(50))], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0, "") for i in range(60)], LABELS)
    seen = []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, y: seen.append(len(rows)) or real(rows, y))
    quality.quality_scores(docs, labels, fit_rows=20).count()
    assert seen and seen[0] <= 20


def test_held_out_labels_are_never_learned(spark):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, "some text", "", "", "") for i in range(300)], DOCS)
    labels = spark.createDataFrame([(i, 0, 0, "") for i in ids], LABELS)
    assert {r.score for r in quality.quality_scores(docs, labels).collect()} == {1.0}


def edits(a, b):
    """Letters more, less or other, and neighbours that changed places."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j - 1] + (a[i - 1] != b[j - 1]), d[i - 1][j] + 1, d[i][j - 1] + 1)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_equals_edit_distances():
    rng, entries = random.Random(3), ["clown", "trash", "disgusting", "worthless", "scum", "gracias"]
    automaton = toxicity.Automaton([*entries, "lowei*"])
    for _ in range(3000):
        w = list(rng.choice(entries))
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randint(0, 1)] = rng.choice(["", "a", "s", "t", "w"])
        if rng.random() < 0.5:
            i = rng.randrange(max(1, len(w) - 1))
            w[i:i + 2] = reversed(w[i:i + 2])
        w = "".join(w)
        assert automaton.spelt(w) == sorted((e, edits(w, e)) for e in entries if edits(w, e) <= toxicity.allowed(e)), w
    assert automaton.spelt("loweischaft") == [("lowei*", 0)] and automaton.spelt("lowfischaft") == []


def test_swaps_and_short_entries_are_misspellings():
    automaton = toxicity.Automaton(["idiot", "stupid", "scum", "dumb", "ass"])
    for word, entry in [("idoit", "idiot"), ("stpuid", "stupid"), ("scumm", "scum"), ("duumb", "dumb"), ("dubm", "dumb"), ("as", "ass")]:
        assert (entry, 1) in automaton.spelt(word)
    # where misspellings of an entry are common words, they are worth nothing and are not looked for
    matcher = toxicity.Matcher(["ass", "scum"], {"ass": [3.0, -1.0], "scum": [3.0, 1.0]})
    assert [(e, d) for e, d, _ in matcher.matches("as soon as ass scmu")] == [("ass", 0), ("scum", 1)]


def test_toxicity_finds_swapped_letters_and_short_words(spark):
    rng, data = random.Random(14), []
    for i, t in enumerate(corpus(700, 2)):
        words, toxic = t.split(), i % 3 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "stupid", "scum", "dumb", "jerk"]))
        data.append((i, " ".join(words), int(toxic)))
    got = scored(spark, data, ["such an idoit here", "how stpuid is rain", "all scumm there", "so duumb a thing", "a jrek here", "a quiet day of rain"])
    assert [r.predicted for r in got] == [1, 1, 1, 1, 1, 0]


def test_context_separates_quotation_from_abuse():
    def factor(text):
        tokens = text.split()
        return toxicity.context(tokens, next(i for i, t in enumerate(tokens) if "idiot" in t))
    assert factor('He used the slur "idiot" in his talk') == toxicity.QUOTED
    assert factor("she called them an idiot once") < 1
    assert factor("you are an idiot") == toxicity.AIMED
    assert factor('token = "abc" and what an idiot "x y"') == 1.0


def toxic_corpus():
    """Insults in a third of the texts, one text in very many copies."""
    rng, out = random.Random(8), []
    for i, t in enumerate(corpus(600, 2)):
        words, toxic = t.split(), i % 3 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["moronic", "disgusting", "worthless", "zlopqua", "zlopben", "zlopdir"]))
        out.append((i, " ".join(words), int(toxic)))
    return out + [(1000 + i, out[0][1], out[0][2]) for i in range(60)]


def test_toxicity_learns_words_stems_and_misspellings(spark):
    data = toxic_corpus()
    more = [(5000, "they are disgustng people here"), (5001, "zlopnew thing"), (5002, "a quiet day of rain"), (5003, None), (5004, ""), (5005, "rain " * 40_000 + "worthless")]
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t, _ in data] + [(i, t, "", "", None) for i, t in more] + [(None, "x", "", "", "")] * 2, DOCS)
    labels = spark.createDataFrame([(i, 1, y, "") for i, _, y in data], LABELS)
    got = {}
    for r in toxicity.toxicity_scores(docs, labels).collect():
        got[r.doc_id] = r
    held = [got[i].predicted == y for i, _, y in data if got[i].held_out]
    assert len(held) > 100 and np.mean(held) >= 0.98
    assert [got[i].predicted for i in range(5000, 5006)] == [1, 1, 0, 0, 0, 1]


def inflected():
    """An insult with inflected forms, so that its beginning is chosen before its words."""
    rng, data = random.Random(4), []
    for i, t in enumerate(corpus(600, 2)):
        words, toxic = t.split(), i % 3 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "idiots", "idiotic", "stupid", "stupids", "worthless"]))
        data.append((i, " ".join(words), int(toxic)))
    return data


def scored(spark, data, texts):
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t, _ in data] + [(5000 + i, t, "", "", "") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, spark.createDataFrame([(i, 1, y, "") for i, _, y in data], LABELS)).collect()}
    held = [got[i].predicted == y for i, _, y in data if got[i].held_out]
    assert len(held) > 100 and np.mean(held) >= 0.98
    return [got[5000 + i] for i in range(len(texts))]


def test_toxicity_finds_misspellings_inside_a_beginning(spark):
    got = scored(spark, inflected(), ["such an idiut here", "all ideots there", "a stuqid thing", "xidiotic rain", "a quiet day of rain", "one idiot here", "one idiot idiots idiotic idiut here"])
    assert [r.predicted for r in got] == [1, 1, 1, 1, 0, 1, 1]
    assert abs(got[5].score - got[6].score) < 0.05  # a beginning and its forms count once


def test_strongest_match_of_a_word_counts():
    odds = {"idio*": [3.0], "idiot": [2.0, 1.0], "idiots": [2.5, 1.5]}
    assert [(e, d) for e, d, _ in toxicity.Matcher(sorted(odds), odds).matches("idiots idiot ideots")] == [("idio*", 0), ("idio*", 0), ("idiots", 1)]


def test_digits_and_signs_inside_a_word_cost_an_edit():
    matcher = toxicity.Matcher(["stupid", "idiot", "worthless", "disgusting", "clown"])
    for token, want in [("stup1d", [("stupid", 1)]), ('"id*ot!",', [("idiot", 1)]), ("w0rthl3ss", [("worthless", 2)]), ("$tupid", [("stupid", 1)]), ("_idiot_", [("idiot", 0)]),
                        ("idiot-clown", [("idiot", 0), ("clown", 0)]), ("1d1ot", []), ("stupid7", [("stupid", 0)]), ("17:30", []), ("***", [])]:
        assert matcher.of_token(token) == want, token


def test_toxicity_finds_words_spelt_with_digits_and_signs(spark):
    got = scored(spark, inflected(), ["such an idi0t here", "a (stup1d) thing", "so st*pid!", "w0rthless rain", "1d10t st0p1d at 17:30"])
    assert [r.predicted for r in got] == [1, 1, 1, 1, 0]


def test_toxicity_without_toxic_labels(spark):
    docs = spark.createDataFrame([(1, "a moron", "", "", ""), (2, None, "", "", "")], DOCS)
    got = toxicity.toxicity_scores(docs, spark.createDataFrame([], LABELS)).collect()
    assert [r.predicted for r in got] == [0, 0] and got[0].score == got[1].score
