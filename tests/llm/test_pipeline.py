import corpus_pipeline
from sheafmill.llm import bpe, decontaminate, near_copies, quality, secrets

SF = "/root/testdata/sf0.001"


def test_stages_like_brute_force(spark):
    """Each stage against plain Python over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}

    field = quality.fit(docs, quality.quality_labels(spark, SF))
    good = {i: r for i, r in rows.items() if field.scores([r["text"]])[0] >= quality.THRESHOLD}
    out = corpus_pipeline.keep_good_documents(spark, docs, SF)
    assert out.columns == columns and {r["doc_id"] for r in out.collect()} == set(good)
    assert 0.5 * len(rows) < len(good) < len(rows)

    ids = sorted(good)
    sets = [near_copies.shingles(good[i]["text"]) for i in ids]  # the stage's rule: five words, similarity 0.8
    links = [(a, b) for a in range(len(ids)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = list(range(len(ids)))
    while any(root[a] != root[b] for a, b in links):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    single = {ids[a] for a in range(len(ids)) if root[a] == a}
    assert len(single) < len(ids)
    docs = spark.createDataFrame([tuple(r.values()) for r in good.values()], docs.schema)
    out = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, SF)
    assert out.columns == columns and {r["doc_id"] for r in out.collect()} == single

    items = [decontaminate.item_shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        words = decontaminate.words_of(text)
        own = {tuple(words[i : i + 5]) for i in range(len(words))}
        return any(x and len(x & own) >= 0.8 * len(x) for x in items)

    clean = {i for i in single if not leaks(good[i]["text"])}
    docs = docs.filter(docs["doc_id"].isin(sorted(single)))
    out = corpus_pipeline.drop_benchmark_leaks(spark, docs, SF)
    assert out.columns == columns and {r["doc_id"] for r in out.collect()} == clean

    docs = docs.filter(docs["doc_id"].isin(sorted(clean)))
    out = corpus_pipeline.redact_secrets(spark, docs, SF)
    safe = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == columns and set(safe) == clean
    for i, r in safe.items():
        text = good[i]["text"]
        spans = secrets.scan(text)[1]
        assert r["text"] == (secrets.redact(text, spans) if spans else text)
        assert r["n_chars"] == len(r["text"]) and not secrets.base_spans(r["text"])

    ids = {r["doc_id"]: r["ids"] for r in corpus_pipeline.encode(spark, out, SF).collect()}
    assert {i: bpe.codec().decode(x).decode() for i, x in ids.items()} == {i: r["text"] for i, r in safe.items()}

    final = {r["doc_id"]: (r["ids"], r["exact"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert final == {i: (x, True) for i, x in ids.items()}


def test_nothing_in_nothing_out(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
