"""Brute-force versions, round trips and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlake.llm import chat, decontaminate, html_blocks, language_id, packing, quality, queries, seekable_warc, token_counts, toxicity
from stintlake.llm.common import bpe_path, piece_path
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


# -- archives ----------------------------------------------------------------


def test_bundle_is_plain_zstandard_and_seekable(tmp_path):
    import zstandard

    chance = random.Random(4)
    records = [chance.randbytes(chance.randint(0, 900)) * chance.randint(1, 40) for _ in range(200)]
    writer = seekable_warc.BundleWriter(f"file://{tmp_path}/a.warc.zst", frame_bytes=20_000)
    places = [writer.add(r) for r in records]
    writer.close()
    reader = seekable_warc.BundleReader(f"{tmp_path}/a.warc.zst")
    assert len(reader.frames) > 5
    order = list(range(200))
    chance.shuffle(order)
    assert all(reader.record(*places[i], len(records[i])) == records[i] for i in order)
    with open(tmp_path / "a.warc.zst", "rb") as whole:
        assert zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read() == b"".join(records)


def test_archives_give_back_pages_and_revisits(spark, tmp_path):
    body = "<p>é" + "x" * 100
    rows = [(3, "http://a/ b%20\r\n", body), (1, None, body), (2, "u", "short"), (4, "v", "short"), (5, "w", None), (3, "z", body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = seekable_warc.write_archives(seekable_warc.with_revisits(pages), str(tmp_path), frame_bytes=200, bundle_bytes=300)
    got = sorted(seekable_warc.read_archives(index).collect(), key=lambda r: (r.page_id, r.url or ""))
    assert [(r.page_id, r.url, r.record_type, r.refers_to, bytes(r.payload).decode()) for r in got] == [
        (1, None, "response", None, body),
        (2, "u", "response", None, "short"),
        (3, "http://a/ b%20\r\n", "revisit", 1, ""),
        (3, "z", "revisit", 1, ""),
        (4, "v", "response", None, "short"),
        (5, "w", "response", None, ""),
    ]
    one = seekable_warc.read_archives(index.where("record_id = 4")).collect()
    assert [bytes(r.payload) for r in one] == [b"short"]


# -- pages -------------------------------------------------------------------


def test_main_text_of_a_page_with_everything():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li><a>News</a></ul></nav>
    <div class="cookie-notice">We use cookies for a great many things, please accept them all.</div>
    <main><article class="post with-sidebar"><h1>Title</h1><p>Real <b>te</b>xt &amp; <i>more</i>   here.<p>Short.
    <ul><li>Point one<li>Point <a href="q>r">two</a></ul><aside>An aside of quite a few words that reads like a text</aside>
    <div class="relatedStories"><a>Other story</a></div><script>var x = "<p>no</p>"</script><!-- <p>no</p> -->
    <section id="comments"><article><p>I think that this is a very nice article, thank you for it.</p></article></section>
    </article></main><form><label>Mail</label><input></form><footer>&copy; x</footer></body></html>"""
    assert html_blocks.main_text(page).split("\n\n") == ["Title", "Real text & more here.", "Short.", "Point one", "Point two"]


SENTENCE = "The town council has met again and talked for hours about the new bridge over the river"


@pytest.mark.parametrize(
    "odd",
    [
        "<svg class=icon/>",
        "<svg/><p>Between.</p><svg><text>no</text></svg>",
        "<math display='block'/>",
        "<object data=x>",
        "<object data=x><p>Between.</p><object data=y>no</object>",
        "<svg><svg>no</svg>no</svg>",
        "<iframe src=x/>",
    ],
)
def test_text_after_elements_without_an_end(odd):
    page = f"<html><body><article><h1>Title</h1><p>{SENTENCE} one.</p>{odd}<p>{SENTENCE} two.</p></article></body></html>"
    between = ["Between."] if "Between" in odd else []
    assert html_blocks.main_text(page).split("\n\n") == ["Title", f"{SENTENCE} one.", *between, f"{SENTENCE} two."]


@pytest.mark.parametrize("tag", ["article", "main"])
def test_article_in_a_form_around_the_page(tag):
    menu = "<nav><a href=x>Home</a></nav><div class=login><input> Your name and your password, please enter them here</div>"
    page = f"<body><form id=aspnetForm>{menu}<{tag}><h1>Title</h1><p>{SENTENCE}.</p></{tag}><footer>&copy; x</footer></form></body>"
    assert html_blocks.main_text(page) == f"Title\n\n{SENTENCE}."


def test_marks_of_paragraphs():
    page = f"""<article><p class="advert">{SENTENCE} ad.<p>{SENTENCE} one.</p><p hidden>{SENTENCE} no.</p><p class=promo>{SENTENCE} ad.
    <div>{SENTENCE} two.</div><custom><p style="display:none">{SENTENCE} no.</p></custom><p class=lead>{SENTENCE} three.</article>"""
    assert html_blocks.main_text(page).split("\n\n") == [f"{SENTENCE} {n}." for n in ("one", "two", "three")]


def test_main_text_without_article():
    words = "plain words of a page that has no article element but a good deal of text in two paragraphs"
    page = f"<div class=menu><a>A</a><a>B</a></div><p>{words} one</p><p>{words} two</p><div><a>More</a> <a>Links</a></div>"
    assert html_blocks.main_text(page) == f"{words} one\n\n{words} two"
    assert html_blocks.main_text(None) == html_blocks.main_text("<p") == ""


# -- languages ---------------------------------------------------------------


def test_buckets_do_not_depend_on_pieces(monkeypatch):
    text = "Ein Été 12 - naïve \U0001f600 cafés.  " * 50 + "İ"
    whole = np.sort(np.concatenate(list(language_id.gram_buckets(text))))
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    spaced = " " + " ".join(letters.split()) + " "
    assert len(whole) == sum(len(spaced) - n + 1 for n in (1, 2, 3)) - 1  # the space in front is no 1-gram
    for piece in (1, 2, 3, 7, 64):
        monkeypatch.setattr(language_id, "_PIECE", piece)
        assert np.array_equal(whole, np.sort(np.concatenate(list(language_id.gram_buckets(text)))))


def test_score_is_the_posterior():
    weights = np.log(np.random.default_rng(1).dirichlet(np.ones(1 << language_id.BUCKET_BITS), 2).T)
    model = language_id.Model(["a", "b"], np.log([0.5, 0.5]), weights)
    total = [math.fsum(weights[b, k] for part in language_id.gram_buckets("ab") for b in part) for k in (0, 1)]
    lang, score = model.score("ab")
    assert lang == "ab"[int(total[1] > total[0])]
    assert score == pytest.approx(1 / (1 + math.exp(-abs(total[0] - total[1]))))
    assert model.score("12 *") == model.score(None) == ("und", 0.0)


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id.identify(docs).join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    out = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97


# -- decontamination ---------------------------------------------------------


def semi_global(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return min(row)


def test_matcher_against_the_whole_distance_table():
    chance = random.Random(6)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()
    items = [(i, decontaminate.normalised(" ".join(chance.choices(words, k=chance.randint(4, 25))))) for i in range(12)]
    matcher, met = decontaminate.Matcher(items), 0
    for _ in range(150):
        _, item = chance.choice(items)
        letters = list(item)
        for _ in range(chance.randint(0, len(item) // 8)):
            at = chance.randrange(len(letters))
            letters[at : at + chance.randint(0, 1)] = chance.choice(["", "q", "zz"])
        text = " ".join(chance.choices(words, k=20)) + " " + "".join(letters) + " " + " ".join(chance.choices(words, k=20))
        text = decontaminate.normalised(text)
        want = {i: semi_global(t, text) for i, t in items if len(t) >= decontaminate.LEAST_CHARS}
        want = {i: d for i, d in want.items() if d <= int(decontaminate.EDIT_RATE * len(dict(items)[i]))}
        assert {i: d for i, _, _, d in matcher.hits(text)} == want
        met += len(want)
    assert met > 50


def test_blocks_of_a_large_benchmark(spark):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    whole = decontaminate.contamination(docs, items).select("doc_id", "item_ids").collect()
    cut = decontaminate.contamination(docs, items, block_chars=2000).select("doc_id", "item_ids").collect()
    assert sorted(whole) == sorted(cut) and any(r.item_ids for r in whole)
    hit = {r.doc_id for r in whole if r.item_ids}
    exact = docs.crossJoin(F.broadcast(items.selectExpr("text AS item"))).where("contains(text, item)")
    assert {r.doc_id for r in exact.collect()} <= hit


# -- packing -----------------------------------------------------------------


def test_packing_covers_all_tokens_once(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).selectExpr("doc_id", "if(doc_id % 9 = 0, null, text) AS text")
    special = spark.createDataFrame([(900, "a <|endoftext|> b"), (901, "   \n\n  " * 50 + "あ\U0001f600"), (902, "z" * 9000)], docs.schema)
    docs = docs.unionByName(special)
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces = packing.pack(docs.repartition(5), bpe_path(), length=256).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, text in texts.items():
        mine = sorted(by_doc[doc_id], key=lambda p: p.start)
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in mine), "<u4").tolist()
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert [p.start for p in mine] == list(np.cumsum([0] + [p.length for p in mine[:-1]]))
        assert {p.doc_tokens for p in mine} == {len(ids)}
    fill = []
    for number in range(len(by_sequence)):
        mine = sorted(by_sequence[number], key=lambda p: p.offset)
        assert [p.offset for p in mine] == list(np.cumsum([0] + [p.length for p in mine[:-1]]))
        fill.append(sum(p.length for p in mine))
    assert set(fill[:-1]) == {256} and 0 < fill[-1] <= 256
    whole = packing.sequences(packing.pack(docs, bpe_path(), length=256), 256).collect()
    assert all(len(s.ids) == 4 * (s.tokens if bin(s.tokens).count("1") == 1 else 256) for s in whole)


# -- quality -----------------------------------------------------------------


def test_base_rules_against_python(spark):
    chance = random.Random(8)
    texts = [" ".join(chance.choices("a b c d e f g h i j".split(), k=n)) for n in (0, 1, 7, 8, 9, 15, 16, 17, 40)]
    texts += ["one two three four five six seven eight " * 3, "x\n\n x\nx\ny *#\n\t\ny *#", "p q r s t u v w p q r s t u v w z p q r", " a  b"]
    for r in quality.judge(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")).collect():
        text = texts[r.doc_id]
        words = [w.decode() for w in text.encode().split()]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_distance_of_histograms(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    got = spark.range(1).select(quality.js_distance(F.lit(p), F.lit(q)).alias("d"), quality.js_distance(F.lit(p), F.lit(p)).alias("same")).first()
    assert got.d == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2)) and got.same == 0


def test_junk_goes_and_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.judge(docs)
    rows = judged.join(labels, "doc_id").where("not base_failed and class_distance is not null").collect()
    good, junk = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(junk) / len(junk) < 0.4
    kept = {r.doc_id for r in judged.where("kept").collect()}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == kept


def test_rare_languages_are_held_against_themselves_or_not_at_all(spark):
    """Clean texts without any common word: 12 of one language among 3,000 others, 2 of another."""
    chance = random.Random(11)
    english = [" ".join(chance.choices(quality.COMMON_WORDS["en"].split(), k=20) + chance.choices("house river stone cloud garden".split(), k=60)) for _ in range(40)]
    strange = lambda: " ".join("".join(chance.choices("aeioukltnsh", k=6)) for _ in range(400))
    texts = [(english[i % 40] + f" w{i}", "en") for i in range(3000)] + [(strange(), "fi") for _ in range(12)] + [(strange(), "qx") for _ in range(2)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string").repartition(8)
    rare = quality.judge(docs).where("doc_id >= 3000").collect()
    assert len(rare) == 14 and all(r.kept and not r.base_failed for r in rare)
    assert all((r.word_distance is None) == (r.doc_id >= 3012) for r in rare)
    assert quality.keep_good(docs).where("lang <> 'en'").count() == 14


# -- toxicity ----------------------------------------------------------------


def test_gradients_against_differences():
    chance = np.random.default_rng(2)
    p = {k: v.astype(np.float64) for k, v in toxicity.new_parameters().items()}
    p["word"] = chance.standard_normal(p["word"].shape) * 0.3
    words = toxicity.features(["ab", "c", "defg"])
    ids = np.zeros((3, toxicity.WINDOW), np.int64)
    ids[0, :5], ids[1, :2] = [1, 2, 3, 1, 1], [3, 2]
    target, drop = np.array([1.0, 0.0, 1.0], np.float32), np.ones((3, 1), np.float32)
    grads, _ = toxicity.gradients(p, words, ids, target, drop)

    def loss():
        return toxicity.gradients(p, words, ids, target, drop)[1]

    for name in p:
        if isinstance(grads[name], tuple):
            full = np.zeros_like(p[name])
            np.add.at(full, grads[name][0], grads[name][1])
            places = [(grads[name][0][0], 1), (grads[name][0][-1], 4)]
        else:
            full = grads[name]
            places = [tuple(chance.integers(0, s) for s in full.shape) for _ in range(4)]
        for at in places:
            held, step = p[name][at], 1e-2
            p[name][at] = held + step
            up = loss()
            p[name][at] = held - step
            down = loss()
            p[name][at] = held
            assert full[at] == pytest.approx((up - down) / (2 * step), rel=0.03, abs=3e-5), name


def test_windows_cover_a_text():
    for n in (0, 1, 24, 25, 36, 37, 100):
        found = toxicity.windows_of(np.arange(1, n + 1))
        assert set(found[found > 0].tolist()) == set(range(1, n + 1))
        assert all(b[0] - a[0] == toxicity.STRIDE for a, b in zip(found, found[1:]) if b[0])


def test_scores_do_not_depend_on_company():
    scorer = toxicity.Scorer(toxicity.new_parameters())
    texts = ["one two three " * 40, None, "", "... !!!", "four"] + [f"w{i} x{i}" for i in range(300)]
    together = scorer.texts(texts)
    alone = np.array([toxicity.Scorer(toxicity.new_parameters()).texts([t])[0] for t in texts[:8]])
    assert np.allclose(together[:8], alone, atol=2e-6)
    assert together[1] == together[2] == together[3]
    assert scorer.texts(["so, so so. SO bad"])[0] == scorer.texts(["so so so so bad"])[0] != scorer.texts(["so so bad"])[0]


def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic = rows["toxic"].to_numpy() == 1
    assert 0.05 < toxic.mean() < 0.2 and len(rows) > 500
    order = rows["score"].rank().to_numpy()
    area = (order[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    said = rows["predicted"].to_numpy() == 1
    # all "clean" would have a recall of 0, all "toxic" a precision of 0.12, chance an area of 0.5
    assert area > 0.94 and said[toxic].mean() > 0.9 and said[toxic].sum() / said.sum() > 0.88


def test_scores_against_a_walk_word_by_word():
    """The worst window of a text, one word and one unit at a time in plain Python."""
    p = toxicity.new_parameters(3)
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    n, text = toxicity.HIDDEN, "The quick, brown fox jumps over the lazy dog and " * 4 + "idiot idiot idiot idiot 😀 İstanbul"

    def vector(word):
        own, trigrams, _ = toxicity.features([word])
        return [float(v) for v in p["word"][own[0]]] + [sum(float(p["trigram"][t][k]) for t in trigrams) / len(trigrams) for k in range(toxicity.WIDTH)]

    def states(words, side):
        h, out = [0.0] * n, []
        for x in words if side == "fore" else words[::-1]:
            given = [sum(a * float(w) for a, w in zip(x, p[f"{side}_in"][:, j])) + float(p[f"{side}_bias"][j]) for j in range(3 * n)]
            past = [sum(a * float(w) for a, w in zip(h, p[f"{side}_state"][:, j])) for j in range(3 * n)]
            z, r = ([sigmoid(given[k * n + j] + past[k * n + j]) for j in range(n)] for k in (0, 1))
            new = [math.tanh(given[2 * n + j] + r[j] * past[2 * n + j]) for j in range(n)]
            h = [a + (1 - b) * (c - a) for a, b, c in zip(h, z, new)]
            out.append(h)
        return out if side == "fore" else out[::-1]

    words, scores = toxicity.words_of(text), []
    for at in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE):
        window = [vector(w) for w in words[at : at + toxicity.WINDOW]]
        both = [a + b for a, b in zip(states(window, "fore"), states(window, "back"))]
        weigh = [math.exp(sum(a * float(b) for a, b in zip(s, p["attention"]))) for s in both]
        pooled = [sum(w * s[k] for w, s in zip(weigh, both)) / sum(weigh) for k in range(2 * n)]
        scores.append(sigmoid(sum(a * float(b) for a, b in zip(pooled, p["out"])) + float(p["out_bias"][0])))
    assert toxicity.Scorer(p).texts([text])[0] == pytest.approx(max(scores), abs=2e-5)


def test_a_toxic_passage_anywhere_in_a_long_text(spark):
    """Windows of the whole text are learnt and scored; words said over and over are scored as they stand."""
    chance = random.Random(12)
    plain = lambda n: " ".join(chance.choices("river house stone cloud garden market bridge town council green old".split(), k=n))
    rows = [(i, f"{plain(100)} vile awful scum {plain(100)}" if i % 4 == 0 else plain(chance.choice([40, 400])), int(i % 4 == 0)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    sample = toxicity.sample_windows(df, df.select("doc_id", "toxic"), "doc_id", "text", "doc_id", "toxic", 800, 1600)
    assert all(len(r.windows.split("\n")) == max(1, -(-(len(rows[r.id][1].split()) - 24) // 12) + 1) for r in sample.itertuples())
    scorer = toxicity.Scorer(toxicity.train(sample, epochs=30))  # so few texts need many rounds
    asked = [f"{plain(5000)} vile awful scum {plain(3000)}", plain(9000), "cloud " * 900, "zebra " * 900]
    assert (scorer.texts(asked) >= 0.5).tolist() == [True, False, False, False]



# -- conversations -----------------------------------------------------------


def test_template_is_read_back_exactly(spark):
    chance = random.Random(3)
    bits = [*chat.CONTROLS, "\\", "\\\\", "n", "\n", "<", "|", "<|", "\\n", "x", "</s", "turn", "INST]"]
    pick = lambda n: "".join(chance.choices(bits, k=chance.randint(0, n)))
    rows = [(i, j, pick(6), pick(12)) for i in range(200) for j in range(3)]
    turns = chat.canonical(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id")
    written = chat.formatted(turns).select("id", "text", chat.read_turns(F.col("text")).alias("again"))
    for r in written.join(turns, "id").collect():
        assert r.again == r.turns
        assert r.text.count(chat.START) == r.text.count(chat.END) == 3
        assert not any(c in r.text for c in chat.CONTROLS[2:])


def test_layouts_by_fingerprint(spark):
    records = [
        (1, '{"prompt":"a","response":"b"}', [("user", "a"), ("assistant", "b")]),
        (2, '{"messages":[{"role":"user","content":"hi"},{"content":"yo","role":"assistant"}]}', [("user", "hi"), ("assistant", "yo")]),
        (3, '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":null}]}', [("user", "q"), ("assistant", "")]),
        (4, '{"output":"o","instruction":"i","input":""}', [("user", "i"), ("assistant", "o")]),
        (5, '{"instruction":"i","input":"x","output":"o"}', [("user", "i\n\nx"), ("assistant", "o")]),
        (6, '{"zzz":1}', None),
        (7, None, None),
        (8, "no json", None),
    ]
    found = chat.canonical_json(spark.createDataFrame([r[:2] for r in records], "id long, j string"), "id", "j")
    got = {r.id: None if r.turns is None else [(t.role, t.text) for t in r.turns] for r in found.collect()}
    assert got == {i: turns for i, _, turns in records}
    nested = spark.createDataFrame([(1, [("user", "u"), ("assistant", None)])], "id long, messages array<struct<role: string, content: string>>")
    assert [(t.role, t.text) for t in chat.canonical(nested, "id").first().turns] == [("user", "u"), ("assistant", "")]
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical(spark.createDataFrame([(1, "x")], "id long, unknown string"), "id")


def test_arrays_by_all_their_elements_and_records_without_a_mapping(spark):
    records = [
        (1, '{"messages":[{"role":"user"},{"content":"yo","role":"assistant"}]}'),
        (2, '{"messages":[{"role":"user","content":"hi"},{"content":"yo","role":"assistant","more":1}]}'),
        (3, '{"messages":[{"role":"user","content":"hi"},"loose"]}'),
        (4, '{"prompt":"a","response":"b","source":"web"}'),
        (5, None),
    ]
    mapped, rejects = chat.split_json(spark.createDataFrame(records, "id long, j string"), "id", "j")
    assert [(r.id, [(t.role, t.text) for t in r.turns]) for r in mapped.collect()] == [(1, [("user", ""), ("assistant", "yo")])]
    assert {r.id: r.json for r in rejects.collect()} == dict(records[1:])


def test_canonical_selects_by_fingerprint(spark, monkeypatch):
    table = spark.createDataFrame([(1, "a", "b")], "id long, response string, prompt string")
    assert [t.text for t in chat.canonical(table, "id").first().turns] == ["b", "a"]
    monkeypatch.setattr(chat, "fingerprint", lambda paths: F.xxhash64(F.array_join(paths, "")) + F.rand())
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical(table, "id")


# -- token counts ------------------------------------------------------------


def unigram(vocabulary):
    from tokenizers import Tokenizer, models, normalizers

    low = min(s for _, s in vocabulary)
    table = [("<unk>", low), *((f"<0x{b:02X}>", low) for b in range(256)), *vocabulary]
    library = Tokenizer(models.Unigram(table, unk_id=0, byte_fallback=True))
    library.normalizer = normalizers.Sequence([normalizers.Prepend(token_counts.MARK), normalizers.Replace(" ", token_counts.MARK)])
    return library


def test_counts_equal_the_library_s(spark):
    library, docs = unigram(token_counts.read_vocabulary(piece_path())), spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    odd = ["", "  a  b ", "日本語", "\U0001f600\U0001f600 x", "a\tb\nc", "    ", "ﬁ é"]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(odd, 5000)), "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == len(library.encode(texts[r.doc_id]).ids) for r in token_counts.token_counts(docs, piece_path()).collect())


def test_ties_as_in_the_library():
    chance, mark = random.Random(2), token_counts.MARK
    for _ in range(200):
        vocabulary = {x: -float(chance.randint(1, 3)) for x in ("a", "b", mark)}
        for _ in range(chance.randint(0, 12)):
            piece = chance.choice(["", mark]) + "".join(chance.choices("abc", k=chance.randint(1, 4)))
            vocabulary[piece] = -float(chance.randint(1, 6))
        counter, library = token_counts.PieceCounter(list(vocabulary.items())), unigram(list(vocabulary.items()))
        for _ in range(20):
            text = "".join(chance.choices("abc  é", k=chance.randint(0, 25)))
            assert counter.count(text) == len(library.encode(text).ids)
