"""The pipeline against its stages written plainly in Python."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from test_operators import base_spans, near_classes, plain_metrics, words


def texts():
    r = random.Random(11)
    passage = " ".join(str(r.randint(0, 9999)) for _ in range(55))
    out = [None, "", "too short", "again and again " * 40]
    for k in range(14):
        body = " ".join(f"w{r.randint(0, 99999)}" for _ in range(r.randint(60, 200)))
        out.append(body + ("\n" + passage if k % 3 == 0 else "") + ('\ntoken = "0123456789abcdef0123"' if k % 4 == 0 else ""))
    out += [out[5], out[6] + " end"]
    return out


def test_stages(spark, tmp_path):
    all_texts = texts()
    docs = spark.createDataFrame(list(enumerate(all_texts)), "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    docs = docs.withColumn("row", F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now = dict(enumerate(all_texts))
    frames = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        frames = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "quality":
            now = {i: t for i, t in now.items() if plain_metrics(t)[-1]}
        elif name == "near_duplicate":
            ids = sorted(now)
            now = {i: now[i] for k, i in enumerate(ids) if near_classes([now[j] for j in ids])[k] == k}
        elif name == "substring":
            first, out = {}, {}
            for d in sorted(now):
                w = words(now[d])
                gone = set()
                for i in range(len(w) - 19):
                    if first.setdefault(tuple(w[i:i + 20]), (d, i)) != (d, i):
                        gone.update(range(i, i + 20))
                out[d] = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else now[d]
            now = out
        elif name == "secrets":
            for d, t in now.items():
                done, at = "", 0
                for a, _, b in base_spans(t):
                    if a >= at:
                        done, at = done + t[at:a] + "[SECRET]", b
                    else:
                        at = max(at, b)
                now[d] = done + t[at:]
        if name != "pack":
            assert frames.columns == docs.columns
            assert {r.doc_id: r.text for r in frames.collect()} == now, name
            assert all(r.n_chars == len(r.text) for r in frames.collect())
    assert {r.doc_id for r in frames.collect()} == set(now)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == frames.count()
