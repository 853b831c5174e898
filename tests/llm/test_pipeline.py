"""The pipeline on the given tables, each stage held against its predecessor's output."""

import collections

from test_models import whole
from test_native import brute_targets
from test_texts import brute_near

import corpus_pipeline
from millrace.llm import decontaminate as dc
from millrace.llm.common import save, table

import zlib


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, {}
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
        seen[name] = docs.collect()
    rows = {name: {r.doc_id: r for r in found} for name, found in seen.items()}
    for name in list(rows)[:-1]:
        assert list(seen[name][0].asDict()) == columns
        assert all(r == before[i] for i, r in rows[name].items())

    labels = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    clean = rows["toxicity"]
    assert sum(i not in clean for i, t in labels.items() if t) >= 0.8 * sum(labels.values())
    assert sum(i not in clean for i, t in labels.items() if not t) <= 0.01 * len(labels)

    kept = rows["minhash_near_dedup"]
    near = brute_near([(i, r.text) for i, r in clean.items()])
    assert set(kept) == {i for i, (_, root) in near.items() if i == root}

    phrases = dc.Phrases([(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()])
    _, spans, _ = dc.search_texts(_strings([r.text for r in kept.values()]), phrases)
    assert set(rows["benchmark_decontamination"]) == {i for i, s in zip(kept, spans) if not s}
    assert len(rows["benchmark_decontamination"]) < len(kept)

    sizes, taken = collections.Counter(), collections.Counter()
    words = {i: len((r.text or "").encode().split()) for i, r in rows["benchmark_decontamination"].items()}
    for i, r in rows["benchmark_decontamination"].items():
        sizes[r.source] += words[i]
    times = collections.Counter(r.doc_id for r in seen["mix_sources"])
    for i, n in times.items():
        taken[before[i].source] += n * words[i]
    assert max(times.values()) <= 2
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= max(w for i, w in words.items() if before[i].source == source)

    at = 0
    order = sorted(seen["mix_sources"], key=lambda r: r.doc_id)
    got = sorted(seen["token_output"], key=lambda r: r.start)
    for row, doc, ids in zip(got, order, whole([r.text for r in order]), strict=True):
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc.doc_id, at, len(ids) // 4, zlib.crc32(ids))
        at += row.n_tokens


def _strings(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())
