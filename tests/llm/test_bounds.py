"""What may be large without a bound: languages, benchmarks, texts without spaces, records of any depth."""

import json
import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from stintlake.llm import chat, decontaminate, language_id, token_counts
from stintlake.llm.common import piece_path

DOCS = "doc_id long, text string, lang string"


def test_languages_in_blocks_of_columns(spark, monkeypatch):
    chance = random.Random(3)
    alphabets = {f"l{k:02}": "".join(chance.sample("abcdefghijklmnopqrstuvwxyz", 6)) for k in range(11)}
    word = lambda lang: "".join(chance.choices(alphabets[lang], k=5))
    rows = [(i, " ".join(word(lang) for _ in range(30)), lang) for i, lang in enumerate(list(alphabets) * 12)] + [(900, None, "l00"), (901, "12 !", "l01"), (902, "abc", None)]
    docs = spark.createDataFrame(rows, DOCS)
    whole = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", 4)
    blocks = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    assert {k: v[0] for k, v in whole.items()} == {k: v[0] for k, v in blocks.items()}
    assert all(np.isclose(v[1], blocks[k][1]) for k, v in whole.items())
    assert whole[900] == whole[901] == ("und", 0.0) and whole[902][0] != "und"
    assert np.mean([whole[i][0] == lang for i, _, lang in rows[:-3]]) > 0.95


def test_a_rare_language_is_learnt_beside_a_common_one(spark):
    chance = random.Random(4)
    rows = [(i, " ".join(chance.choices("the and of that house river".split(), k=9)), "en") for i in range(3000)]
    rows += [(5000 + i, " ".join(chance.choices("talo joki ja se on että".split(), k=9)), "fi") for i in range(9)]
    models = language_id.train(spark.createDataFrame(rows, DOCS), documents=200)
    assert [m.languages for m in models] == [["en", "fi"]] and models[0].score("joki ja talo")[0] == "fi"
    assert np.isclose(np.exp(models[0].prior), [3000 / 3009, 9 / 3009]).all()


def test_a_benchmark_in_blocks_gives_what_one_block_gives(spark):
    chance = random.Random(5)
    text = lambda n: " ".join("".join(chance.choices("abcdefghij", k=5)) for _ in range(n))
    items = [(i, text(8)) for i in range(30)] + [(3, text(9)), (7, None), (None, text(8)), (50, "!!")]
    docs = [(i, f"{text(20)} {items[i % 30][1]} {text(20)}" if i % 3 else text(30), "en") for i in range(45)] + [(99, None, "en"), (100, "", "en")]
    docs, items = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    whole, cut = (sorted(map(str, decontaminate.contamination(docs, items, block_chars=n).collect())) for n in (1 << 24, 200))
    assert whole == cut and sum("contaminated=True" in r for r in whole) == 30
    blocks = list(decontaminate.item_blocks(items, "item_id", "text", 200))
    assert len(blocks) > 5 and sorted(i for b in blocks for i, _ in b) == sorted([*range(30), 3])
    assert sum(3 in {i for i, _ in b} for b in blocks) == 1
    kept = {r.doc_id for r in decontaminate.keep_clean(docs.withColumn("_hits", F.lit(1)), items, block_chars=200).collect()}
    assert kept == {i for i in range(45) if i % 3 == 0} | {99, 100}


def test_long_texts_without_spaces(monkeypatch):
    counter = token_counts.counter(piece_path())
    chance = random.Random(6)
    for _ in range(60):
        text = "".join(chance.choices("abcdet日\U0001f600 ", weights=[9, 9, 9, 9, 9, 9, 1, 1, 1], k=chance.randint(1, 200)))
        counter.known.clear()
        monkeypatch.setattr(token_counts, "LONG", 10_000)
        plain = counter.count(text)
        counter.known.clear()
        monkeypatch.setattr(token_counts, "LONG", 1)
        assert counter.count(text) == plain
    monkeypatch.setattr(token_counts, "LONG", 10_000)
    long = "abcdet" * 300_000 + "\U0001f600" + "tedcba" * 300_000
    tracemalloc.start()
    counter.count(long)
    assert tracemalloc.get_traced_memory()[1] < 12 * len(long)  # the text itself three times over, no list of positions
    tracemalloc.stop()


def test_records_by_their_fields_to_any_depth(spark):
    part = {"type": "text", "text": "hi"}
    records = {
        1: {"messages": [{"role": "user", "content": "hi"}]},
        2: {"messages": [{"role": "user", "content": [part]}]},
        3: {"prompt": ["a", "b"], "response": "c"},
        4: {"prompt": "a", "response": {"text": "c"}},
        5: {"messages": [{"role": "user", "content": "hi"}, {"role": "user", "content": [part]}]},
        6: {"messages": []},
        7: {"prompt": 12, "response": None},
        8: {"conversations": [{"from": "human", "value": 1.5}, {"from": "gpt", "value": 20.25}]},
        13: {"conversations": [{"from": "human", "value": 1.5}, {"from": "gpt", "value": True}]},
        9: {"messages": [[{"role": "user", "content": "hi"}]]},
    }
    rows = [(i, json.dumps(r)) for i, r in records.items()] + [(10, '{"prompt":"a","prompt":"b","response":"c"}'), (11, ""), (12, "[]")]
    mapped, rejects = chat.split_json(spark.createDataFrame(rows, "id long, j string"), "id", "j")
    got = {r.id: [(t.role, t.text) for t in r.turns] for r in mapped.collect()}
    assert got == {1: [("user", "hi")], 7: [("user", "12"), ("assistant", "")], 8: [("user", "1.5"), ("assistant", "20.25")]}
    assert {r.id for r in rejects.collect()} == {i for i, _ in rows} - set(got)
    prints = {r.id: r.fingerprint for r in rejects.collect()}
    assert len({prints[i] for i in (2, 3, 4, 5, 6, 9)}) == 6
