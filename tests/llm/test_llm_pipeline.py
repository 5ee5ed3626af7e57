"""The pipeline's stages against plain versions, and its last rows against its own documents."""

import hashlib
import re
from collections import defaultdict

import corpus_pipeline
from sensorstream.llm import quality, toxicity, words
from sensorstream.llm.common import Scratch
from sensorstream.llm.entries import WORD_BPE, packed
from sensorstream.llm.simhash import fingerprint
from sensorstream.llm.tokenizing import BatchTokenizer, public_path
from sensorstream.llm.words import Memo
from sensorstream.session import settings
from tokenizers import Tokenizer

from test_llm_near import roots_of
from test_llm_tokens import check_packed

SF = "/root/testdata/sf0.01"


def plain_exact(docs):
    groups = defaultdict(list)
    for d in docs:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", d.text).encode()).digest()].append(d)
    return {min(g, key=lambda d: (-len(d.text), d.doc_id)).doc_id for g in groups.values()}


def plain_near(docs):
    prints = {d.doc_id: fingerprint(d.text) for d in docs}
    distinct = sorted(set(prints.values()))
    near = [(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if (a ^ b).bit_count() <= 2]
    root = roots_of(distinct, near)
    least = {}
    for doc, p in prints.items():
        least[root[p]] = min(doc, least.get(root[p], doc))
    return set(least.values())


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scratch, columns = Scratch(spark, "stages"), docs.columns
    good, clean = quality.fit(spark, docs, labels), toxicity.fit(spark, docs, labels)
    memo = Memo(clean.rows_of)
    plain = {
        "quality": lambda rows: {d.doc_id for d in rows if good.scores([d.text])[0] >= 0.3},
        "toxicity": lambda rows: {d.doc_id for d in rows if clean.score(d.text, memo) < 0.7},
        "exact_dedup": plain_exact,
        "simhash_near_dedup": plain_near,
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = scratch.write(stage(spark, docs, SF))
        after = docs.collect()
        assert docs.columns == columns
        assert sorted(d.doc_id for d in after) == sorted(plain[name](before)), name
        assert set(after) <= set(before) and 0 < len(after), name
    library = Tokenizer.from_file(public_path(WORD_BPE))
    texts = [(d.doc_id, d.text) for d in after]
    check_packed([tuple(r) for r in corpus_pipeline.pack(spark, docs, SF).collect()], texts, library)
    ran = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in ran.select("doc_id").collect()} == {d.doc_id for d in after}


def test_stages_take_odd_documents(spark, documents, odd_rows):
    scratch = Scratch(spark, "odd")
    for rows in (odd_rows, []):
        docs = documents(rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = scratch.write(stage(spark, docs, SF))
            assert out.schema.names == docs.schema.names, name
            assert out.count() <= len(rows)
        last = corpus_pipeline.pack(spark, docs, SF)
        assert last.count() >= len(rows)


def test_small_tables_take_few_files_whatever_the_shuffle(spark, documents, monkeypatch):
    """Each file starts a process beside the executor; a shuffle of many partitions made thousands."""
    rows = [(k, f"some words of text {k // 2} that a near copy shares " * 5 + "x" * (k % 2)) for k in range(60)]
    docs = Scratch(spark, "few").write(documents(rows).coalesce(2))
    folder, plain, written = spark._jvm.org.apache.hadoop.fs.Path, Scratch.path, []
    monkeypatch.setattr(Scratch, "path", lambda self: written.append(plain(self)) or written[-1])
    monkeypatch.setattr(Scratch, "drop", lambda self, *frames: None)
    many = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, many):
        for _, stage in corpus_pipeline.STAGES[2:]:
            out = stage(spark, docs, SF)
            assert out.rdd.getNumPartitions() <= 2
            assert out.select("doc_id").distinct().count() >= 1
    assert len(written) > 10
    for path in written:
        files = folder(path).getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder(path))
        assert sum(f.getPath().getName().startswith("part-") for f in files) <= 2, path


def test_packing_in_fewer_tasks_than_ranges_is_whole(spark, documents, odd_rows):
    library = Tokenizer.from_file(public_path(WORD_BPE))
    docs = Scratch(spark, "ranges").write(documents([r for r in odd_rows if r[0] not in (6, None)]).repartition(3))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        for many in (1, 2):
            pieces = packed(docs, most_ranges=many)
            assert pieces.rdd.getNumPartitions() <= many
            check_packed([tuple(r) for r in pieces.collect()], texts, library)


def test_a_worker_keeps_the_words_of_one_operator():
    memo = quality._memo()
    assert quality._memo() is memo
    model = toxicity.ToxicityModel({}, *[quality.np.zeros((1, 4))] * 2, 0.0)
    assert toxicity._memo_for(model) is toxicity._memo_for(model)
    encoder = BatchTokenizer.of_worker(public_path(WORD_BPE), 1)
    assert BatchTokenizer.of_worker(public_path(WORD_BPE), 1) is encoder
    assert [kept for _, kept in words._held] == [encoder]
    assert quality._memo() is not memo
