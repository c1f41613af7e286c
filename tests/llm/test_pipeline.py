"""The pipeline's stages against plain versions on a few hundred documents."""

import os
import random
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from stintlake.llm import decontaminate, language_id, quality, simhash
from stintlake.llm.common import bpe_path
from stintlake.session import staging_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _print(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _one_of_each(rows):
    """Smallest ids of the groups of fingerprints within two bits, by comparing all pairs."""
    prints = {i: _print(t) for i, t in rows.items()}
    distinct = sorted(set(prints.values()))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in distinct:
        for b in distinct:
            if a < b and bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for i, p in prints.items():
        groups[find(p)].append(i)
    return {min(ids) for ids in groups.values()}


def _holds(text, item):
    """Whether a passage of the text is within the error budget of the item, by the whole table of distances."""
    text, item = decontaminate.normalised(text), decontaminate.normalised(item)
    if len(item) < decontaminate.LEAST_CHARS:
        return bool(item) and text == item
    row = list(range(len(item) + 1))
    budget = int(decontaminate.EDIT_RATE * len(item))
    for c in text:
        last, row[0] = row[0], 0
        for j, d in enumerate(item, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        if row[-1] <= budget:
            return True
    return False


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stage(spark, docs, SF).cache()
    texts = {n: {r.doc_id: r.text for r in out[n].select("doc_id", "text").collect()} for n in list(out)[:4]}
    raw = spark.read.parquet(f"{SF}/documents.parquet")

    models = language_id.train(raw.where(~language_id.held_out("doc_id")))
    scored = {r.doc_id: models[0].score(r.text) for r in raw.collect()}
    assert set(texts["language_id"]) == {i for i, (lang, score) in scored.items() if lang != "und" and score >= 0.5}

    judged = quality.judge(out["language_id"])
    assert set(texts["quality_rules"]) == {r.doc_id for r in judged.where("kept").collect()}

    assert set(texts["near_dedup"]) == _one_of_each(texts["quality_rules"])

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    chance = random.Random(1)
    some = chance.sample(sorted(texts["near_dedup"]), 25)
    gone = set(texts["near_dedup"]) - set(texts["decontamination"])
    for i in [*some, *sorted(gone)[:15]]:
        text = texts["near_dedup"][i][:3000] if i not in gone else texts["near_dedup"][i]
        if len(text) <= 3000:
            assert any(_holds(text, x) for x in items) == (i in gone), i

    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(bpe_path()).encode
    pieces = sorted(out["packing"].collect(), key=lambda p: (p.doc_id, p.start))
    ids = defaultdict(list)
    for p in pieces:
        assert p.start == len(ids[p.doc_id]) and 0 <= p.offset and p.offset + p.length <= 2048
        ids[p.doc_id] += [int.from_bytes(p.ids[4 * k : 4 * k + 4], "little") for k in range(p.length)]
    assert dict(ids) == {i: [*encode(t, add_special_tokens=False).ids, 1] for i, t in texts["decontamination"].items()}


def test_run_removes_what_is_read_again(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "an item of a benchmark, longer than twenty")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    shared = staging_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.collect() == [] and "sequence_id" in done.columns
    (folder,) = [n for n in set(os.listdir(shared)) - before if n.startswith("corpus-")]
    assert os.listdir(f"{shared}/{folder}") == ["4-packing"]


def test_one_of_repeated_rows_stays(spark):
    rows = [(1, "the quick brown fox jumps over the dog", "en"), (1, "the quick brown fox jumps over the dog", "en"), (2, "the quick brown fox jumps over the dog", "en")]
    rows += [(3, "quite another text about the bridge and its costs", "en"), (None, "x", "en"), (None, "x", "en")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("_kept", F.lit(1)))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3] and "_kept" in kept.columns
