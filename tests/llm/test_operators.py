"""Every operator on small rows with nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import base64
import collections
import hashlib
import html.parser
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from feedmill.llm import (
    compression,
    contamination,
    html_text,
    jaccard,
    licenses,
    packing,
    quality_rules,
    token_counts,
    training_order,
    warc,
)
from feedmill.session import scratch_dir

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, row string, c string, key string, node string, lang string"


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    words = ["".join(pick.choice("aeiourstlnm") for _ in range(pick.randint(2, 8))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


BASE = prose(1, 300)
TEXTS = [
    (1, BASE),
    (2, BASE),
    (3, BASE.replace(BASE.split()[100], "changed")),
    (4, prose(2, 200)),
    (4, prose(2, 200)),
    (5, None),
    (6, ""),
    (7, " \n\t "),
    (8, "two words"),
    (9, "TWO   Words"),
    (None, BASE),
    (None, None),
    (10, prose(3, 30_000)),
    (11, "mit license and mit  LICENSE, cc-by"),
    (2**60, prose(4, 60) + "\n" + prose(4, 60)),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, "r", "c", "k", "n", "xx") for i, t in TEXTS], SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def brute_links(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, set()).add(frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset())
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                    low = min(group[a], group[b])
                    changed |= group[a] != low or group[b] != low
                    group[a] = group[b] = low
    return group


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_jaccard_against_all_pairs(docs, none, n, percent):
    rule = jaccard.Rule(n, percent)
    want = brute_links([r for r in TEXTS if r[0] is not None], n, percent)
    got = jaccard.link(docs, rule).collect()
    assert len(got) == len(TEXTS)
    assert {r.doc_id: r.component_id for r in got} == want | {None: None}
    assert jaccard.link(none, rule).count() == 0


def test_jaccard_blocks_of_one_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 5)
    words = prose(7, 150).split()
    rows = []
    for i in range(40):
        w = list(words)
        for k in random.Random(i).sample(range(150), 1 + i % 4):
            w[k] = f"x{i}y{k}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string"), jaccard.Rule(3, 90)).collect()}
    assert got == brute_links(rows, 3, 90)


def test_one_of_each_group_stays(docs, none):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 5, 6, 7, 8, 10, 11, 2**60]
    assert kept.where("doc_id IS NULL").count() == 2
    assert jaccard.keep_one(none).count() == 0


def brute_counts(text):
    text = text or ""
    words = [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_verdicts(docs, none):
    got = quality_rules.judge(docs, carry=["doc_id", "text"]).select(
        "row.text", "c.n_words", "c.word_chars", "c.n_symbols", "c.n_dup_lines", "c.n_repeat_words", "base_failed", "kept"
    ).collect()
    for text, *counts, failed, kept in got:
        assert tuple(counts) == brute_counts(text)
        assert failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (failed and kept)
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.keep_good(none).count() == 0


def test_a_rule_that_fires_alone_is_outvoted():
    good = tuple([1] * 9)
    odd = tuple([1] * 8 + [0])
    bad = tuple([0] * 6 + [1] * 3)
    model = quality_rules.estimate([(good, 900), (odd, 60), (bad, 80)])

    def p(votes):
        return model.prior + sum(model.odds[r][v] for r, v in zip(quality_rules.RULES, votes))

    assert p(good) > 0 and p(odd) > 0 and p(bad) < 0


def test_licenses(docs, none, spark):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[11].n_base, got[11].first_word, got[11].last_word, got[11].base_labels) == (3, 0, 5, "cc-by,mit")
    assert (got[5].n_words, got[5].n_base, got[5].first_word, got[5].labels, got[5].score) == (0, 0, None, "", 0.0)
    notice = licenses.TEMPLATES[0][1].replace("any person", "any other person").replace("software", "code", 1)
    rows = spark.createDataFrame([(1, prose(5, 50) + " " + notice + " " + prose(6, 50))] * 2, "doc_id long, text string")
    found = licenses.scan(rows).collect()
    assert [r.labels for r in found] == ["mit", "mit"] and all(0.5 <= r.score < 1 for r in found)
    assert licenses.scan(none).count() == 0


def test_classifier(docs, none, spark):
    rows = [(i, prose(i, 80), 1) for i in range(60)] + [(100 + i, " ".join(w + "***" for w in prose(i, 80).split()), 0) for i in range(60)]
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = compression.fit(table, labels)
    scored = {r.doc_id: r.score for r in compression.score(table, model).select("row.doc_id", "score").collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert held and np.mean([(scored[i] >= 0.7) == bool(y) for i, _, y in held]) > 0.9
    edge = compression.score(docs, model)
    assert edge.where("score IS NULL OR score < 0 OR score > 1").count() == 0 and edge.count() == len(TEXTS)
    assert compression.score(none, compression.fit(none, labels.limit(0))).count() == 0


def test_classifier_learns_from_the_labels_of_its_own_input(spark):
    """Counts and sample leave out labels of rows that an earlier stage dropped."""
    rows = [(i, prose(i, 80)) for i in range(400)] + [(1000 + i, prose(i, 80).replace(" ", "*** ")) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    gone = [(10_000 + i, 0) for i in range(20_000)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows] + gone, "doc_id long, quality int")
    assert compression.fit(table, labels) == compression.fit(table, labels.where("doc_id < 10000"))
    kept = {r.doc_id for r in compression.score(table, compression.fit(table, labels)).where("predicted = 1").select("row.doc_id").collect()}
    assert len([i for i in kept if i < 1000]) >= 396 and len([i for i in kept if i >= 1000]) <= 3


@pytest.mark.parametrize("n_good, n_bad", [(400, 0), (400, 2), (3, 2), (0, 0)])
def test_classifier_rejects_no_good_row_with_hardly_any_bad_rows(spark, n_good, n_bad):
    rows = [(i, prose(i, 80)) for i in range(400)] + [(1000 + i, prose(i, 80).replace(" ", "*** ")) for i in range(n_bad)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, 1) for i in range(n_good)] + [(1000 + i, 0) for i in range(n_bad)] + [(10_000 + i, 0) for i in range(900)]
    model = compression.fit(table, spark.createDataFrame(marks, "doc_id long, quality int"))
    kept = compression.score(table, model).where("predicted = 1")
    assert kept.where("row.doc_id < 1000").count() == 400


def test_token_counts_and_cache(docs, none, spark, monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    cache = scratch_dir(spark, "cache")
    want = collections.Counter()
    for i, t in TEXTS:
        n = len(library.encode(t or ""))
        want[(i, len((t or "").encode()), n, n > 4096)] += 1
    assert bag(token_counts.count(docs, PIECE, cache)) == want
    size = spark.read.parquet(cache).count()
    assert size == len({t or "" for _, t in TEXTS})
    assert bag(token_counts.count(docs, PIECE, cache)) == want
    assert spark.read.parquet(cache).count() == size
    assert token_counts.count(none, PIECE, scratch_dir(spark, "cache")).count() == 0


def test_token_counts_of_hot_and_other_texts(spark):
    """Rows of a text that half of the table shares, and others; the cache holds a key twice, as two runs may leave it."""
    rows = [(i if i % 3 else None, "hot text" if i % 2 else f"text {i // 4}") for i in range(5000)]
    table, cache = spark.createDataFrame(rows, "doc_id long, text string"), scratch_dir(spark, "cache")
    first = bag(token_counts.count(table, PIECE, cache))
    spark.read.parquet(cache).limit(900).write.mode("append").parquet(cache)
    assert spark.read.parquet(cache).count() == 1251 + 900
    again = token_counts.count(table, PIECE, cache)
    assert bag(again) == first and spark.read.parquet(cache).count() == 1251 + 900
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert first == collections.Counter((i, len(t), len(library.encode(t)), False) for i, t in rows)


def test_packing_round_trip(docs, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    pieces = packing.pack(docs, WORD, window=64).collect()
    filled = collections.defaultdict(int)
    texts = collections.defaultdict(bytes)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled[p.sequence_id] and len(p.ids) == 4 * p.length and zlib.crc32(p.ids) == p.ids_crc32
        filled[p.sequence_id] += p.length
    sizes = [filled[k] for k in sorted(filled)]
    assert all(n == 64 for n in sizes[:-1]) and sorted(filled) == list(range(len(sizes)))
    for p in sorted(pieces, key=lambda p: (p.doc_id or -1, p.sequence_id, p.offset)):
        if p.doc_id not in (None, 4):
            assert len(texts[p.doc_id]) == 4 * p.start
            texts[p.doc_id] += p.ids
    for i, t in TEXTS:
        if i not in (None, 4):
            ids = library.encode(t or "", add_special_tokens=False).ids + [2]
            assert np.frombuffer(texts[i], "<u4").tolist() == ids
    assert packing.pack(none, WORD).count() == 0


def test_words_beyond_ascii_are_encoded_as_by_the_library():
    from tokenizers import Tokenizer

    texts = ["Ǆ İstanbul ΣΑΣ. a.b, x., .,, 's. don't. Á. J̌ <|endoftext|>. \x1cfoo\x85bar z", "", " \n ", "ﬁ． ｆ．", "It's. THEY'RE, ok"]
    library = Tokenizer.from_file(WORD)
    got = packing.WordEncoder(WORD).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_strings_in_capitals_are_encoded_as_by_the_library():
    from tokenizers import Tokenizer

    texts = ["a <|ENDOFTEXT|> b", "A <|endoftext|> B", "x<|EndOfText|>y <|STARTOFTEXT|>.", "A <| B |> C"]
    library = Tokenizer.from_file(WORD)
    got = packing.WordEncoder(WORD).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000])
def test_feistel_is_a_permutation(n):
    out = training_order.permute(np.arange(n), n, 99)
    assert sorted(out) == list(range(n))
    assert (training_order.permute(out, n, 99, back=True) == np.arange(n)).all()


def test_shards_hold_every_sequence(docs, none, spark):
    folder = scratch_dir(spark, "shards")
    listing = training_order.streams(docs, WORD, scratch_dir(spark, "streams"))
    index = training_order.materialise(listing, folder, 5, window=64, per_shard=8)
    read = training_order.read_back(index, folder, window=64).collect()
    want = {r.sequence_id: zlib.crc32(r.ids) for r in packing.sequences(packing.pack(docs, WORD, window=64)).collect()}
    assert {r.sequence_id: r.ids_crc32 for r in read} == want
    assert sorted(r.slot for r in read) == list(range(len(want)))
    assert all((r.shard, r.byte_offset) == (r.slot // 8, r.slot % 8 * 128) for r in read)
    empty = training_order.streams(none, WORD, scratch_dir(spark, "streams"))
    assert training_order.materialise(empty, scratch_dir(spark, "shards"), 5).count() == 0


def test_warc_round_trip(spark):
    long = "é" * 800
    rows = [(1, "http://a/é x", long), (2, None, long), (9, "u", long), (9, "u", long), (None, "u", long), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "u", "\x1f\x8b\x08 " + prose(1, 60_000))]
    pages = spark.createDataFrame([(*r, "z", "z") for r in rows], "page_id long, url string, html string, digest string, first string")
    listing = warc.write(warc.decide(pages), scratch_dir(spark, "warc"))
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = bag(warc.read(listing, split=500).select(fields))
    want = collections.Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        revisit = h == long and i != 9
        want[(i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None)] += 1
    assert got == want
    assert got == bag(warc.read(listing).select(fields))
    every = warc.read(listing).collect()
    (response,) = {r.record_id for r in every if r.page_id == 9}
    assert {r.refers_to_record for r in every if r.record_type == "revisit"} == {response}
    assert all(r.intact for r in every if r.record_type == "response")
    assert warc.read(warc.write(warc.decide(pages.limit(0)), scratch_dir(spark, "warc"))).count() == 0


def test_warc_payload_that_half_of_all_rows_share(spark):
    """Its rows stay where they are; the others of the join, short or shared by few, are dealt over its tasks."""
    rows = [(i, "u", ("hot " * 300) if i % 2 else f"{i // 6 * 6 + i % 6 // 4} " * 400) for i in range(4000)] + [(None, "u", "")] * 500
    rows += [(10_000 + i, f"u{i}", "") for i in range(1500)]
    decided = warc.decide(spark.createDataFrame(rows, "page_id long, url string, html string"))
    last = {}
    for i, _, h in rows:
        if len(h) >= 1000:
            last[h] = max(last.get(h, i), i)
    want = collections.Counter((i, hashlib.sha1(h.encode()).hexdigest(), None if last.get(h, i) == i else last[h]) for i, _, h in rows)
    assert bag(decided.select("page_id", "digest", "refers_to")) == want
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [digest_if_large" in plan


def member(head, block):
    whole = head.encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def foreign_records():
    """Records as other programs write them: (member, expected fields)."""
    page = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>\xc3\xa9</p>"
    payload = b"<p>\xc3\xa9</p>"
    sha, b32 = hashlib.sha1(payload).hexdigest(), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    info = b"software: x\r\n"
    ask = b"GET / HTTP/1.1\r\nHost: a\r\n\r\n"
    sha_of = lambda b: hashlib.sha1(b).hexdigest()
    return [
        (member(f"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n", info), (len(info), sha_of(info), "warcinfo", None, None)),
        (member(f"WARC/1.0\r\nwarc-type:request\r\nCONTENT-TYPE:application/http;msgtype=request\r\ncontent-length:{len(ask)}\r\nwarc-record-id:<urn:a>\r\n\r\n", ask), (0, sha_of(b""), "request", "<urn:a>", None)),
        (member(f"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http;\r\n msgtype=response\r\nWARC-Record-ID: <urn:b>\r\nWARC-Payload-Digest: sha1:{b32}\r\nContent-Length: {len(page)}\r\n\r\n", page), (len(payload), sha, "response", "<urn:b>", True)),
        (member(f"WARC/1.1\nWARC-Type: metadata\nWARC-Payload-Digest: sha1:{'0' * 40}\nContent-Length: 2\n\n", b"ab"), (2, sha_of(b"ab"), "metadata", None, False)),
        (member(f"WARC/0.18\r\nWARC-Type: revisit\r\nContent-Type: application/http\r\nWARC-Payload-Digest: sha1:{b32}\r\nWARC-Refers-To: <urn:b>\r\nContent-Length: 19\r\n\r\n", b"HTTP/1.1 200 OK\r\n\r\n"), (None, sha, "revisit", None, None)),
        (member("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Payload-Digest: md5:00\r\nContent-Length: 0\r\n\r\n", b""), (0, sha_of(b""), "resource", None, None)),
    ]


@pytest.mark.parametrize("split", [7, 100, 10**6])
def test_warc_archives_written_elsewhere(spark, tmp_path, split):
    made = foreign_records() * 3
    path = tmp_path / "other.warc.gz"
    path.write_bytes(b"".join(m for m, _ in made))
    listing = warc.listing_of(spark, [path.as_uri()])
    got = warc.read(listing, split=split, strict=False)
    assert bag(got.select("payload_bytes", "payload_digest", "record_type", "record_id", "intact")) == collections.Counter(w for _, w in made)
    assert {r.refers_to_record for r in got.collect() if r.record_type == "revisit"} == {"<urn:b>"}
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read(listing, split=split).collect()


def test_warc_places_that_only_look_like_records(tmp_path):
    """Gzip magic in a payload, members with another content, headers cut short and lengths that do not fit."""
    good = warc.record(1, "u", b"x" * 50, hashlib.sha1(b"x" * 50).hexdigest(), None)
    wrong = [
        b"\x1f\x8b\x08junk",
        member("no archive at all", b"WARC/1.1"),
        member("WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"no length"),
        member("WARC/1.1\r\nContent-Length: 2\r\n\r\n", b"no"),
        member("WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 900\r\n\r\n", b"too short"),
        member("WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\n", b"too long"),
        member("WARC/1.1\r\nWARC-Type: response\r\nContent-Length", b""),
        good[: len(good) // 2],
    ]
    path = tmp_path / "a.warc.gz"
    for noise in wrong:
        path.write_bytes(noise + good + good)
        assert [at for at, _ in warc.records(path.as_uri(), 0, 10**6)] == [len(noise), len(noise) + len(good)], noise


PAGES = {
    "<html><head><title>T</title><script>var a='<p>x</p>';</script></head><body><nav><a href=/>Home</a></nav><div class='ad'>Buy, now.</div><article><h1>A&amp;B</h1><p><b>One,  two.<br><p>To.</p></article><div id=comments><p>Nice, really. Very nice.</p></div><footer>&copy; x</footer></body></html>": "A&B One, two. To.",
    "<div class='menu'><a>a</a></div><h1>T</h1><div><p>A long one, with text, and more of it.</p><p>To.</p></div><aside>More, and more.</aside>": "T A long one, with text, and more of it. To.",
    "plain &lt;text&gt;": "plain <text>",
    "<p>cut <b": "cut",
    "": "",
    "<script>x": "",
}


def test_html_text(spark):
    rows = [(i, "u", h, "t", "r") for i, h in enumerate([*PAGES, None])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, row string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(pages).select("row.page_id", "text", "n_chars").collect()}
    assert got == {i: (t, len(t)) for i, t in enumerate([*PAGES.values(), ""])}
    assert html_text.extract(pages.limit(0)).count() == 0


PROSE = "A long one, with text, and more of it; so it goes on, and on."
NODES = {
    # No <article>: what leads and trails in the element around the content stays, links and other elements go.
    f"<div><a href=/>Home</a></div><div><div>By me</div><p>{PROSE}</p><p>{PROSE}</p><ul><li><a>more</a></li></ul><div>The end</div></div><div>(c) x</div>": f"By me {PROSE} {PROSE} The end",
    f"<div><h2>T</h2><p>{PROSE}</p><div>Bye</div></div><div><ul><li><a>b</a></li><li><a>c</a></li></ul></div>": f"T {PROSE} Bye",
    f"<table><tr><td><ul><li><a>b</a></li></ul></td><td><p>{PROSE}</p><p>To.</p>End</td></tr></table>": f"{PROSE} To. End",
    # An <article> that holds teasers only does not win over the text outside it.
    f"<article><a>Teaser</a></article><div><p>{PROSE}</p><p>{PROSE}</p></div><article><a>Other</a></article>": f"{PROSE} {PROSE}",
    # Links in an <article> on a path of their own are not content; links among its paragraphs are.
    f"<article><h1><a>T</a></h1><p>{PROSE}</p><p><a>See this</a></p><ul><li><a>b</a></li><li><a>c</a></li></ul><div>End</div></article><div>x</div>": f"T {PROSE} See this End",
    f"<main><h1>T</h1><p>{PROSE}</p><div><a>b</a></div><p>To.</p></main>": f"T {PROSE} To.",
    # What stands beside the sections of an <article>, or between parts of it; inline elements set aside are no blocks.
    f"<article><div>By me</div><section><p>{PROSE}</p></section><div>Quote</div><section><p>{PROSE}</p></section></article>": f"By me {PROSE} Quote {PROSE}",
    f"<div><div>x</div><div><p>{PROSE}</p></div><div>Quote</div><div><p>A<span class=ad>d</span>nd. {PROSE}</p></div><div>y</div></div>": f"{PROSE} Quote And. {PROSE}",
}


def unnamed(page, *tags):
    """A page with these elements made plain <div>, and those of class "ad" with them if <nav> is one."""
    for tag in tags:
        page = re.sub(rf"<(/?){tag}(?: [^>]*)?>", r"<\1div>", page)
    return page.replace('<div class="ad">', "<div>") if "nav" in tags else page


def given_pages():
    import pyarrow.parquet as pq

    return pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()


class TagPaths(html.parser.HTMLParser):
    """(path, text, link characters) of every block of a page of plain elements, with paths as tuples of tags."""

    def __init__(self, page):
        super().__init__()
        self.path, self.nodes, self.parts, self.link, self.in_link, self.unseen = (), [], [], 0, False, 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.nodes.append((self.path, text, min(self.link, len(text))))
        self.parts, self.link = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("meta", "br", "b"):
            self.parts.append(" " if tag == "br" else "")
        elif tag == "a":
            self.in_link = True
        else:
            self.flush()
            if tag == "p" and self.path[-1:] == ("p",):
                self.path = self.path[:-1]
            self.path += (tag,)
            self.unseen += tag in ("head",)

    def handle_endtag(self, tag):
        if tag == "a":
            self.in_link = False
        elif tag in self.path:
            self.flush()
            self.path = self.path[: len(self.path) - 1 - self.path[::-1].index(tag)]
            self.unseen -= tag in ("head",)

    def handle_data(self, data):
        if not self.unseen:
            self.parts.append(data)
            self.link += len(data.strip()) * self.in_link


def brute_content(nodes):
    """The content paths by their definition, node by node, all names weighing alike."""
    of = {path: [n for n in nodes if n[0] == path] for path, *_ in nodes}
    text = [sum(len(t) - k for _, t, k in of[p]) / len(of[p]) for p, *_ in nodes]
    mark = [(1 + sum(ch in ".,;:!?…。，、！？；：" for _, t, _ in of[p] for ch in t)) / len(of[p]) for p, *_ in nodes]

    def smooth(x):
        return [(x[max(0, i - 1)] + 2 * x[i] + x[min(len(x) - 1, i + 1)]) / 4 for i in range(len(x))]

    fused = [a * b for a, b in zip(smooth(text), smooth(mark))]
    score = {p: np.mean([f for n, f in zip(nodes, fused) if n[0] == p]) for p in of if sum(len(t) - k for _, t, k in of[p])}
    line = min(html_text.LEVEL * np.mean([f * f for f in fused]) ** 0.5, max(score.values()))
    return {p for p in score if score[p] >= line}


def test_html_content_paths_by_brute_force():
    pages = [unnamed(page, "article", "nav", "footer") for page in given_pages()]
    for page in pages:
        nodes = TagPaths(page).nodes
        read = html_text._Page(page)
        assert [(t, k) for _, _, t, k in read.blocks] == [(t, k) for _, t, k in nodes]
        chosen = html_text.content_paths(read.blocks, read.weights)
        want = brute_content(nodes)
        assert [b[0] in chosen for b in read.blocks] == [n[0] in want for n in nodes]


@pytest.mark.parametrize("tags", [(), ("article",), ("article", "nav", "footer")])
def test_html_text_hangs_on_the_paths(monkeypatch, tags):
    """Other paths give other texts, whether or not elements have telling names."""
    pages = [unnamed(page, *tags) for page in given_pages()]
    right = [html_text.main_text(page) for page in pages]
    real = html_text.content_paths

    def others(blocks, weights):
        return {b[0] for b in blocks} - real(blocks, weights)

    for choose in (others, lambda blocks, weights: {b[0] for b in blocks}, lambda blocks, weights: {blocks[0][0]}):
        monkeypatch.setattr(html_text, "content_paths", choose)
        assert not any(html_text.main_text(page) == text for page, text in zip(pages, right))


@pytest.mark.parametrize("tags, least", [((), 1.0), (("article",), 1.0), (("nav", "footer"), 0.96), (("article", "nav", "footer"), 0.8)])
def test_html_articles_are_found_with_and_without_names(tags, least):
    pages = given_pages()
    want = [" ".join(t for p, t, _ in TagPaths(page).nodes if "article" in p) for page in pages]
    got = [html_text.main_text(unnamed(page, *tags)) for page in pages]
    assert np.mean([g == w for g, w in zip(got, want)]) >= least
    assert all(w in g for g, w in zip(got, want))


def test_html_of_any_kind_is_read():
    pick = random.Random(8)
    bits = ["<div>", "</div>", "<p>", "</p>", "<article>", "</article>", "<a href=x>", "</a>", "<nav>", "</nav>", "<h2>", "</h2>", "<li>", "<ul>", "</ul>", "<span class=ad>", "</span>", "Some text, and more. ", "x", "&lt;", "<", ">", "<!--", "-->", "<script>", "</script>", "<td>", "<tr>", "</table>", "<table>", "<div hidden>"]
    for _ in range(3000):
        page = "".join(pick.choice(bits) for _ in range(pick.randint(1, 40)))
        text = html_text.main_text(page)
        assert text == " ".join(text.split())


def test_html_paths_pick_the_content():
    assert {page: html_text.main_text(page) for page in NODES} == NODES


def test_decontamination(docs, none, spark):
    item = prose(50, 30)
    changed = item.split()
    changed[7] = changed[19] = "zzz"
    more = spark.createDataFrame([(70, prose(51, 80) + " " + " ".join(changed).upper() + " " + prose(52, 80)), (71, prose(53, 90)), (72, "so " + " ".join(prose(54, 6).split()))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, prose(54, 6)), (3, None), (None, item), (4, "")], "item_id long, text string")
    found = contamination.overlaps(more, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(70, 1), (72, 2)}
    assert [(r.first_word, r.n_words, r.n_equal) for r in found if r.doc_id == 70] == [(80, 30, 28)]
    assert [r.doc_id for r in contamination.clean(more, bench).collect()] == [71]
    assert bag(contamination.clean(docs, bench)) == bag(docs)
    assert contamination.clean(docs, bench.limit(0)).count() == len(TEXTS) and contamination.clean(none, bench).count() == 0
    parts = list(contamination.blocks(bench, block_words=8))
    assert len(parts) > 1 and sorted(i for p in parts for i, _ in p) == [1, 2, 4]


def changes():
    """Change patterns of items: all of 10 to 14 words, every n-th word at each phase, and random ones of 38 words."""
    for n in range(10, 15):
        yield from (tuple(i >> k & 1 for k in range(n)) for i in range(2**n))
    for n in (15, 38, 55):
        for step in range(2, 12):
            yield from (tuple(int(k % step == phase) for k in range(n)) for phase in range(step))
    pick = random.Random(3)
    yield from (tuple(int(pick.random() < share) for _ in range(38)) for share in (0.1, 0.2, 0.25, 0.3) for _ in range(1500))


def test_every_overlap_that_is_accepted_has_a_hit():
    words = [f"w{k}" for k in range(55)]
    index = {n: contamination.Index([(1, " ".join(words[:n]))]) for n in [*range(10, 16), 38, 55]}
    item = contamination.word_hashes(" ".join(words))
    other = contamination.word_hashes(" ".join(f"x{k}" for k in range(55)))
    accepted, missed = 0, []
    for pattern in changes():
        n = len(pattern)
        changed = np.where(np.array(pattern, dtype=bool), other[:n], item[:n])
        if contamination.overlap(changed, item[:n], 0)[2] >= contamination.LEAST_EQUAL:
            accepted += 1
            if not index[n].candidates(changed):
                missed.append(pattern)
    assert accepted > 3000 and not missed


def test_excerpts_and_short_items_are_found():
    words = [f"w{k}" for k in range(38)]
    index = contamination.Index([(1, " ".join(words)), (2, " ".join(f"s{k}" for k in range(11))), (3, " ".join(f"t{k}" for k in range(7)))])
    around = " ".join(f"y{k}" for k in range(20))

    def found(part):
        return [(i, equal) for i, *_, equal in contamination.passages(f"{around} {' '.join(part)} {around}", index)]

    assert all(found(words[k : k + n]) == [(1, n)] for n in (10, 11) for k in range(38 - n))
    assert all(found([f"s{j}" if j != k else "zz" for j in range(11)]) == [(2, 10)] for k in (0, 4, 5, 6, 10))
    assert found([f"t{k}" for k in range(7)]) == [(3, 7)] and found([f"t{k}" for k in range(6)]) == []


@pytest.mark.parametrize("stage", ["quality_classifier", "near_duplicates", "decontamination", "packing"])
def test_pipeline_hands_texts_to_python_workers_in_small_batches(spark, docs, stage, tmp_path):
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a passage")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for kind in ("Records", "Bytes"):
        spark.conf.unset(f"spark.sql.execution.arrow.max{kind}PerBatch")
    dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    for n, length in ((3000, 10), (200, 1_000_000)):
        texts = spark.range(0, n, 1, 1).selectExpr(f"repeat('x', {length}) AS text")
        got = texts.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
        assert sum(r.rows for r in got) == n
        assert max(r.rows for r in got) <= 500 and max(r.bytes for r in got) <= 12_000_000


def test_the_word_encoder_gives_back_what_it_worked_with(monkeypatch):
    encoder, given = packing.WordEncoder(WORD), []
    want = encoder.encode(["a b c", ""])

    class Pool:
        def release_unused(self):
            given.append(True)

    monkeypatch.setattr(packing.pa, "default_memory_pool", Pool)
    assert encoder.encode(["a b c", ""]) == want and given == [True]


def test_pipeline_runs_and_keeps_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == columns
    assert 0 < docs.count() < before


def test_texts_that_share_an_id_are_told_apart(spark):
    rows = [(1, "a b c d e f g"), (1, "t u v w x y z k l m"), (2, "t u v w x y z k l m"), (2, "t u v w x y z k l m"), (3, prose(9, 40)), (None, "t u")]
    kept = collections.Counter(r.text for r in jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == collections.Counter({text for _, text in rows})


@pytest.mark.parametrize("n_bad", [0, 1, 3, 19, 21])
def test_scores_differ_however_few_bad_rows_there_are(spark, n_bad):
    rows = [(i, prose(i, 80)) for i in range(200)] + [(1000 + i, prose(i, 80).replace(" ", "*** ")) for i in range(n_bad)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, int(i < 1000)) for i, _ in rows]
    model = compression.fit(table, spark.createDataFrame(marks, "doc_id long, quality int"))
    scored = {r.doc_id: r.score for r in compression.score(table, model).select("row.doc_id", "score").collect()}
    assert len(set(scored.values())) > 100
    assert sum(scored[i] >= 0.7 for i in range(200)) >= 198
    if n_bad > 3:
        assert max(scored[1000 + i] for i in range(n_bad)) < min(scored[i] for i in range(200))


def test_a_dictionary_takes_from_texts_at_even_steps():
    made = compression.dictionary([f"{'#' * (k % 7)}{'a' * 100}" if k < 500 else "9" * 100 for k in range(1000)], 4900)
    assert len(made) <= 4900 and 0.45 < made.count(b"0") / len(made) < 0.55


@pytest.mark.parametrize("n", [999, 1000, 1001, 1999, 2001, 5000])
def test_variety_does_not_fall_with_length(spark, n):
    junk = [f"w{random.Random(i).randint(0, 29)}" for i in range(n)]
    fine = prose(n, n).split()
    table = spark.createDataFrame([(1, " ".join(junk)), (2, " ".join(fine))], "doc_id long, text string")
    got = {r.doc_id: (r.n, r.v_variety) for r in quality_rules.voted(table).select("row.doc_id", "c.n_distinct_words", "v_variety").withColumnRenamed("n_distinct_words", "n").collect()}
    for i, words in ((1, junk), (2, fine)):
        assert got[i][0] == sum(len(set(words[k : k + 1000])) for k in range(0, n, 1000))
    assert (got[1][1], got[2][1]) == (quality_rules.BAD, quality_rules.GOOD)


def notice(label, which=0):
    return [text for name, text in licenses.TEMPLATES if name == label][which]


def test_of_overlapping_notices_the_better_one_counts(spark):
    rows = [(k, f"{prose(k, 30)} {notice(label)} {prose(k + 50, 30)}") for k, label in enumerate(("gpl", "lgpl", "cc-by", "cc-by-sa", "mit", "isc"))]
    rows.append((6, notice("gpl") + " " + prose(3, 40) + " " + notice("lgpl")))
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].labels for k in range(7)] == ["gpl", "lgpl", "cc-by", "cc-by-sa", "mit", "isc", "gpl,lgpl"]
    assert all(got[k].score == 1.0 for k in range(6))


def test_a_phrase_repeated_before_a_notice_does_not_hide_it(spark):
    rows = [(n, "lesser general public license " * n + notice("lgpl")) for n in (1, 6, 50, 200)]
    rows += [(1000 + n, " ".join([notice("mpl")] * n)) for n in (1, 2, 30)]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got[n] for n in (1, 6, 50, 200)) == {"lgpl"} and set(got[1000 + n] for n in (1, 2, 30)) == {"mpl"}


def brute_diagonals(text):
    """Labels by counting, for every template and diagonal, the k-grams that stand there."""
    words = "".join(c.lower() if c.isascii() and c.isalnum() or c > "\x7f" else " " for c in text).split()
    out = set()
    for label, template in licenses.TEMPLATES:
        of = "".join(c.lower() if c.isalnum() else " " for c in template).split()
        grams = [tuple(of[k : k + 4]) for k in range(len(of) - 3)]
        for start in range(-len(of), len(words)):
            held = {k for k, g in enumerate(grams) for d in range(5) if 0 <= start + k + d and tuple(words[start + k + d : start + k + d + 4]) == g}
            if 2 * len(held) >= len(grams):
                out.add(label)
    return out


@pytest.mark.parametrize("share", [0.0, 0.05, 0.1])
def test_altered_notices_against_all_diagonals(spark, share):
    pick, rows = random.Random(int(share * 100)), []
    for k, (label, text) in enumerate(licenses.TEMPLATES):
        words = []
        for word in text.split():
            change = pick.random() < share
            words += [word] if not change else pick.choice([[], ["other"], [word, "inserted"]])
        rows.append((k, f"{prose(k, 20)} {' '.join(words)} {prose(k + 1, 20)}", label))
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for k, text, label in rows:
        found = brute_diagonals(text)
        assert set(filter(None, got[k])) <= found | {"gpl", "mit", "apache", "cc-by"}
        if label in found and len(found) == 1:
            assert label in got[k]


@pytest.mark.parametrize("page", ["<div>x" * 50_000, "<b>x" * 30_000 + "<p>y" * 30_000, "<div>" * 30_000 + "</foo>x" * 30_000])
def test_deep_pages_cost_in_proportion_to_their_length(page):
    import time

    started = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - started < 10
