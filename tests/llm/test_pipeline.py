"""The pipeline next to its stages by brute force."""

import collections

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F

from uptide.llm import mixing, pieces, queries, secrets, simhash, toxicity


def test_every_operator_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}


def test_stages_keep_columns_and_their_decisions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    state, sizes = docs, [docs.count()]
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, sf).cache()
        frames.append(state)
        sizes.append(state.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert state.columns == docs.columns
    toxic, unique, clean, mixed, tokens = frames[1:]
    model = toxicity.train(docs, labels)
    assert {r["doc_id"] for r in toxic.collect()} == {r["doc_id"] for r in toxicity.score_documents(docs, model).where("predicted = 0").collect()}
    fp = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in toxic.collect()}
    kept = sorted(r["doc_id"] for r in unique.collect())
    assert all(bin(fp[a] ^ fp[b]).count("1") > 2 for i, a in enumerate(kept) for b in kept[:i])
    assert all(any(bin(fp[d] ^ fp[k]).count("1") <= 2 for k in fp if k != d) for d in set(fp) - set(kept))
    assert sizes[3] == sizes[2]
    assert all(r["n_chars"] == len(r["text"]) for r in clean.collect())
    live = secrets.secret_report(unique).where("n_live > 0").count()
    assert live == clean.where(F.instr("text", "[SECRET]") > 0).count()
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(clean.withColumn("doc_id", F.xxhash64("doc_id", "text"))).collect()}
    key = clean.select("doc_id", F.xxhash64("doc_id", "text").alias("k")).collect()
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert all(copies[r["doc_id"]] == (int(taken[r["k"]][1] / taken[r["k"]][0] + 0.5) if taken[r["k"]][0] else 1) for r in key)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    out = tokens.collect()
    assert collections.Counter(r["doc_id"] for r in out) == copies
    assert all(r["ids"] == library.encode(texts[r["doc_id"]]) for r in out)


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and out.count() > 0
