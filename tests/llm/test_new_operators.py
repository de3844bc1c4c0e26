"""Fill-in-the-middle, SentencePiece spans and the filter audit against the library or brute force."""

import collections
import hashlib
import itertools
import random
import re

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from feedmill.llm import fill_in_middle, filter_audit, sentence_pieces
from tests.llm.test_operators import PIECE, SCHEMA, TEXTS, docs, none, prose  # noqa: F401

LINES = [
    (20, "one\ntwo\n\nthree"),
    (21, "\n\n\n"),
    (22, "holds <S> a mark\nand more"),
    (23, "almost <P\n> <S\nM> marks <\n<M"),
    (24, "".join(f"zeile {i} é🙂\n" for i in range(20_000))),
    (25, "no line end"),
]


@pytest.fixture
def lined(spark, docs):  # noqa: F811
    return docs.unionByName(spark.createDataFrame([(i, t, "r", "c", "k", "n", "xx") for i, t in LINES], SCHEMA))


def brute_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_and_back(lined, none):  # noqa: F811
    made = fill_in_middle.transform(lined)
    back = fill_in_middle.restore(F.col("fim.output"), F.col("fim.form"))
    got = collections.Counter(tuple(r) for r in made.select("row.doc_id", "row.text", "fim.*", back).collect())
    want = collections.Counter((i, t, *brute_fim(i, t), t or "") for i, t in TEXTS + LINES)
    assert got == want and {r[3] for r in got} == {"plain", "spm", "psm"}
    assert made.select("row.*").columns == lined.columns
    assert fill_in_middle.transform(none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 64, 65, 3000])
def test_skip_list_reaches_every_rank(n):
    points = [random.Random(n + i).randint(0, 9) for i in range(n)]
    lanes = fill_in_middle.SkipList(points)
    assert [lanes.point(r) for r in range(n + 1)] == [0, *itertools.accumulate(points)]


def test_lanes_thin_out():
    sizes = [len(units) for units, _, _ in fill_in_middle.SkipList([1] * 100_000)._lanes]
    assert len(sizes) > 4 and all(4 * b < a for a, b in zip(sizes, sizes[1:]) if a > 64)


def test_a_share_of_texts_stays_plain():
    unit, rule = re.compile(fill_in_middle.LINE), fill_in_middle.Rule(rate=30, spm=100)
    forms = collections.Counter(fill_in_middle.make(str(k), "a\nb\nc", rule, unit)[1] for k in range(2000))
    assert 500 < forms["spm"] < 700 and forms["plain"] == 2000 - forms["spm"]


def odd_texts():
    pick = random.Random(4)
    marks = "ab  \n\t ▁éß日本語🙂\x00.,<0x0A></s>  éÄK½ﬁ"
    yield from ("".join(pick.choice(marks) for _ in range(pick.randint(0, 90))) for _ in range(800))
    yield from ("a" * 5000, " " * 3000, "ab" * 4000, "hello" * 3000, " x  y ", "x ", "日" * 300)


def test_pieces_and_spans_as_by_the_library(spark, docs, none):  # noqa: F811
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = [(100 + k, t) for k, t in enumerate(odd_texts())]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(docs.select("doc_id", "text"))
    got = sentence_pieces.encode(table, PIECE)
    texts = collections.defaultdict(list)
    for i, t in rows + TEXTS:
        texts[i].append(t or "")
    for r in got.collect():
        text = next(t for t in texts[r.doc_id] if library.encode(t) == r.ids)
        texts[r.doc_id].remove(text)
        data = text.encode()
        assert not data or (r.starts[0], r.ends[-1]) == (0, len(data))
        assert r.starts[1:] == r.ends[:-1]
        proto = library.encode(text, return_type="proto")
        for piece, i, start, end in zip(proto.pieces, r.ids, r.starts, r.ends):
            assert (start, end) == (piece.begin, piece.end) or library.is_byte(i)
            if library.is_byte(i):
                assert piece.begin <= start <= end <= piece.end or start < end
    assert not any(texts.values())
    decoded = got.select("doc_id", "ids", sentence_pieces.decode(spark, F.col("ids"), PIECE).alias("text")).collect()
    assert all(r.text == library.decode(r.ids) for r in decoded)
    assert sentence_pieces.encode(none, PIECE).count() == 0


def test_pieces_of_every_text_of_a_table():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()]
    offsets, ids, _, _ = sentence_pieces._model(PIECE).encode(texts)
    want = library.encode(texts)
    assert all(ids[a:b].tolist() == w for a, b, w in zip(offsets, offsets[1:], want))


def test_memory_of_cuts_is_bounded_and_its_loss_harmless(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    monkeypatch.setattr(sentence_pieces, "KNOWN_CUTS", 50)
    with open(PIECE, "rb") as file:
        model = sentence_pieces.Model(file.read())
    for k in range(20):
        text = prose(k, 60)
        assert model.encode([text])[1].tolist() == library.encode(text)
        assert len(model._memory.known) <= 50 + 61


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf", "nmt_nfkc_cf"])
def test_compiled_maps_are_read_as_by_the_library(rule):
    """The maps of the library itself, with and without the trimming of spaces."""
    for kept in (False, True):
        library = sentencepiece.SentencePieceNormalizer(
            rule_name=rule, remove_extra_whitespaces=kept, add_dummy_prefix=kept, escape_whitespaces=kept
        )
        ours = sentence_pieces.Normalizer(dict(sentence_pieces._fields(library.serialized_model_proto()))[3])
        for text in [*odd_texts(), "  ﬁ Ａ　b  ｶﾞ ", "　", "  ", "", "한국 ẹ́x"]:
            got, source = ours(text)
            assert got == library.normalize(text)
            assert len(source) == len(got.encode()) + 1 and (source[1:] >= source[:-1]).all()


def test_a_replaced_sequence_points_at_its_source():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    ours = sentence_pieces.Normalizer(dict(sentence_pieces._fields(library.serialized_model_proto()))[3])
    text = "ﬁ ｶﾞx"
    got, source = ours(text)
    data = got.encode()
    at = {c: int(source[data.index(c.encode())]) for c in ("f", "i", "ガ", "x")}
    place = {c: len(text[: text.index(c)].encode()) for c in ("ﬁ", "ｶ", "x")}
    assert at == {"f": place["ﬁ"], "i": place["ﬁ"], "ガ": place["ｶ"], "x": place["x"]}


def test_other_kinds_of_models_are_refused():
    with pytest.raises(ValueError):
        sentence_pieces.Model(b"")


AUDITED = [
    (1, "alpha beta", "a"),
    (2, "alpha beta", "b"),
    (2, "alpha beta", "b"),
    (3, "alpha beta", None),
    (4, prose(2, 250), "a"),
    (5, prose(2, 250), "a"),
    (5, prose(2, 250), "b"),
    (6, "word " * 300, "a"),
    (7, "WORD # " * 300, "b"),
    (8, None, "a"),
    (9, "", "a"),
    (None, "alpha beta", "a"),
    (None, None, "c"),
    (10, prose(3, 30_000) + " &", "b"),
    (1, prose(2, 250), "a"),
]
MARKS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, 1, 1), (6, 0, 1), (7, None, 1), (10, 1, None), (None, 1, 1), (99, 1, 1)]


def brute_audit(rows, marks):
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, x in marks if x == 1 and i is not None}
    least = collections.defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            least[t or ""].append(i)
    parts = collections.defaultdict(list)
    for i, t, part in rows:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "".join(
            letter
            for letter, bad in zip(
                "ABCDE",
                (
                    len(words) < 200,
                    100 * len(set(words)) < 50 * len(words),
                    100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                    re.search(r"[#$%&*|]", text),
                    i is not None and min(least[text]) < i,
                ),
            )
            if bad
        )
        parts[part or ""].append((fails, i in good, i in toxic))
    out, shapley = {}, collections.Counter()
    for part, found in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = found, []
            for step, letter in enumerate(order, 1):
                here = [f for f in left if letter in f[0]]
                left = [f for f in left if letter not in f[0]]
                before = sum(letter in f[0] for f in gone)
                gone = gone + here
                shapley[part, letter] += len(here)
                alone = sum(f[0] == letter for f in found)
                out[part, order, step] = (len(left), len(here), before, alone, sum(f[1] for f in here), sum(f[2] for f in here))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit_against_every_order(spark):
    rows = spark.createDataFrame([(i, t, p, 1, "x") for i, t, p in AUDITED], "doc_id bigint, text string, source string, n int, mask string")
    labels = spark.createDataFrame(MARKS, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(filter_audit.histogram(rows, labels)).collect()
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in got} == brute_audit(AUDITED, MARKS) and len(got) == 4 * 600
    assert filter_audit.audit(filter_audit.histogram(rows.limit(0), labels)).count() == 0
    bare = filter_audit.audit(filter_audit.histogram(rows, labels.limit(0))).collect()
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in bare} == brute_audit(AUDITED, [])


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
def test_intervals_cover_the_orders_in_which_a_mask_goes(k):
    by_rank = filter_audit.orders(k)
    assert [tuple(o) for o in by_rank] == list(itertools.permutations(range(k)))
    for mask in range(2**k):
        step = {}
        for at, lo, hi in filter_audit.intervals(mask, k):
            for rank in range(lo, hi):
                assert rank not in step
                step[rank] = at
        for rank, order in enumerate(by_rank):
            assert step.get(rank) == next((s for s, letter in enumerate(order) if mask >> letter & 1), None)


def test_every_text_of_a_table_is_encoded_by_words_as_by_the_library():
    import numpy as np
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    from feedmill.llm import packing
    from tests.llm.test_operators import WORD

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()]
    texts += ["x<|ENDOFTEXT|>y A. B, c., É. .,a", "Aa <|endoftext|> BB", "ÀÉ×÷ µª. ŁŹ, å é.", "don't, IT'S. 's 12. a1, --."]
    library, ours, got = Tokenizer.from_file(WORD), packing.WordEncoder(WORD), []
    for lo in range(0, len(texts), 500):
        got += ours.encode(texts[lo : lo + 500])
    for lo in range(0, len(texts), 500):
        want = library.encode_batch_fast(texts[lo : lo + 500], add_special_tokens=False)
        assert all(w.ids == np.frombuffer(g, "<u4").tolist() for w, g in zip(want, got[lo : lo + 500]))


def test_marks_behind_words_are_encoded_as_by_the_library():
    import random

    import numpy as np
    from tokenizers import Tokenizer

    from feedmill.llm import packing
    from tests.llm.test_operators import WORD

    texts = ["gechö### a*** und,$$$ und.*** don't, foo'. foo.'s 's. 'S, a'll.", "x<|endoftext|>. <|endoftext|>, a<| b|> <|.", "", " "]
    # Also what composes, is lowered by its neighbours, counts as white space or as a number, or lies just beside the letters.
    spelt = ["a", "Z", "é", "É", "ß", "×", "÷", "ª", "Σ", "e\u0301", "\u0338", "ŉ", "İ", "1", "²", "'", "'s", ".", ",", "*", "<", "=", "<|", "|>", "…", " ", "  ", "\n", "\t", "\x85", "\u3000", "<|ENDOFTEXT|>", "<|startoftext|>"]
    made = random.Random(7)
    texts += ["".join(made.choices(spelt, k=made.randrange(1, 30))) for _ in range(20_000)]
    library, ours = Tokenizer.from_file(WORD), packing.WordEncoder(WORD)
    got = [x for lo in range(0, len(texts), 500) for x in ours.encode(texts[lo : lo + 500])]
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, w, g in zip(texts, want, got) if w.ids != np.frombuffer(g, "<u4").tolist()] == []
    assert ours.encode(["", ""]) == [b"", b""] and packing.WordEncoder(WORD).encode([""]) == [b""]


def test_a_word_is_encoded_once_whatever_marks_are_behind_it(monkeypatch):
    from feedmill.llm import packing
    from tests.llm.test_operators import WORD

    ours, seen = packing.WordEncoder(WORD), []
    make = ours._memory._make
    monkeypatch.setattr(ours._memory, "_make", lambda words: seen.extend(words) or make(words))
    ours.encode(["Maple maple, maple.*** birch###", "(maple maple; maple, birch. Birch***"])
    ours.encode(["birch.*** maple### a1, a1."])
    assert sorted(w for w in seen if "a" in w or "b" in w) == ["(maple", "a1,", "a1.", "birch", "maple"]
    assert len(seen) == len(set(seen))


def test_the_rarer_half_of_a_memory_is_forgotten():
    import numpy as np

    from feedmill.llm.ragged import Memory

    def make(words):
        order = np.arange(len(words))[::-1]
        spelt = [[ord(c) for c in words[k]] for k in order]
        return order, np.array([c for s in spelt for c in s], dtype=np.uint32), np.array([len(s) for s in spelt])

    memory = Memory(8, make)
    for k in range(200):
        words = ["often", "usual", f"rare{k}", "é" * (k % 5), f"x{k % 50}"][: 3 + k % 3]
        numbers = memory.numbers(words, np.array([9, 8, 1, 1, 1])[: len(words)])
        ids, count = memory.gather(numbers)
        assert "".join(map(chr, ids)) == "".join(words) and count.tolist() == [len(w) for w in words]
        assert len(memory.known) <= 8 + 5 and {"often", "usual"} <= set(memory.known)
