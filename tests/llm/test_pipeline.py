"""The pipeline against a plain composition of its stages."""

import corpus_pipeline
from pyspark.sql import functions as F
from predlake.llm import quality, secrets, toxicity
from test_packing import check
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_and_run_equal_a_plain_composition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    good = [r for r in docs.collect() if quality.vote([quality.terms(r.text)], model)[0] >= quality.ACCEPTED]
    kept = spark.createDataFrame(good, docs.schema)
    lexicon = toxicity.train(kept, labels)
    matcher = toxicity.Matcher(sorted(lexicon["entries"]), lexicon["entries"])
    calm = sorted((r for r in good if toxicity.evidence(matcher.best(r.text), lexicon) < toxicity.TOXIC), key=lambda r: r.doc_id)
    roots = plain_components([plain_fingerprint(r.text) for r in calm])
    single = [r for i, r in enumerate(calm) if roots[i] == i]
    net = secrets.train(spark.createDataFrame(single, docs.schema))
    texts = {}
    for r in single:
        text = r.text
        for _, a, b in reversed(secrets.scan([r.text], net)[0][1]):
            text = text[:a] + secrets.MARK + text[b:] if "\0" not in text[a:b] else text
        texts[r.doc_id] = text
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(spark.createDataFrame(single, docs.schema)).collect()}
    assert clean.keys() == texts.keys()
    check(corpus_pipeline.run(spark, SF).collect(), clean)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_nulls_repeats_ties_long_texts_and_extra_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("kept")).withColumn("bin", F.lit(7))
    words = "the and of with that this for was"
    odd = [(None, None, None, None, None), (None, "", "en", "web", 0), (9001, None, "en", None, None), (9001, None, "en", None, None),
           (9002, f"{words} " * 8000, "en", "web", 264000), (9003, "one short line of plain text", "en", "web", 28), (9003, "one short line of plain text", "en", "web", 28)]
    more = spark.createDataFrame([(*r, "kept", 7) for r in odd], docs.schema)
    docs.unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.unionByName(spark.createDataFrame([(None, 1, 0), (9001, None, None)], labels.schema)).write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(rows) > 50
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text for r in docs.unionByName(more).collect()}
    long = sorted(pieces.get(9002, []), key=lambda r: r.piece)
    if long:      # kept whole, in as many pieces as it takes
        assert long[0].start == 0 and long[-1].end == len(texts[9002]) and all(a.end == b.start for a, b in zip(long, long[1:]))
    assert all(len(v) == len({r.piece for r in v}) for v in pieces.values())      # one of each group of copies is left
    out = docs.unionByName(more)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == docs.columns, name
    assert {r.score for r in out.select("score").distinct().collect()} == {"kept"}
