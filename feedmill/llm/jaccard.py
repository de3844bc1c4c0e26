"""N-gram Jaccard self-join with prefix filters under several global orders.

A document is the set of its distinct word n-grams, as 64-bit hashes. If two sets
of sizes a <= b have a Jaccard similarity of t or more, then under *any* global
order of the n-grams their prefixes, the first ``n - ceil(t * n) + 1`` of each,
share one. Candidates must do so under three orders at once:

1. rare before common, by document frequency. Nearly all n-grams of a document
   that has no near copy occur once, so its prefix can meet nobody and it leaves
   the join here. Frequencies are counted on a hash-selected part of the n-grams
   (those come first in the order, the rest follow by hash), which keeps the
   shuffle a fraction of the corpus; a set that has too few of them for its
   prefix adds the next ones of the order.
2. and 3. two different hash orders, worked out for the sets that are left. Their
   prefixes travel as 32-bit hashes: equal ones are a candidate, never a result.

Only sets with a partner that passes all three and the sizes are sent whole, to be
verified.

Sets that are equal are one class and enter once. Classes that share a prefix
n-gram meet in the group of that n-gram's leader, the least class (by a hash)
that holds it; near copies share most leaders, so a class goes to few groups. A
large group is cut into blocks, every two of which meet in one task: no task
holds more than two blocks, and pairs are never written out. They meet twice, with
their prefixes for the filters and, as far as these leave them a partner, with
their sets. A task returns each class's number of links and a spanning forest of
them, which small- and large-star rounds turn into components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.barrier import evaluate_once
from feedmill.llm.common import bind, discard, land

#: Ids up to this many are broadcast to pick their rows; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Most classes and n-grams in one block of a group.
BLOCK_SETS = 1024
BLOCK_GRAMS = 1_000_000
KNOWN_WORDS = 150_000
#: In sets of fewer n-grams than this, all count towards frequencies.
SMALL = 128
#: Share of rows looked at for frequent n-grams, and the most of these there can be.
FREQUENT_SAMPLE = 1 / 64
MOST_FREQUENT = 10_000
ROWS_AT_ONCE = 500
#: Cells of a membership matrix held at a time.
CELLS = 8_000_000

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64
_ODD = tuple(_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Rule:
    """Documents link when ``100 * intersection >= percent * union`` of their word ``n``-grams.

    ``sample``: share of n-grams, in 65536ths, that frequencies are counted on.
    """

    n: int = 5
    percent: int = 80

    @property
    def sample(self) -> int:
        return min(65536, int(65536 * 1.4 * (100 - self.percent) / 100))

    def least(self, size):
        """The smallest intersection that a set of this size can link with."""
        return -(-self.percent * size // 100)

    def prefix(self, size):
        return size - self.least(size) + 1


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_known = _Hashes()


def _mix(x: np.ndarray, odd: np.uint64) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * odd
    x = (x ^ (x >> _U(29))) * _ODD[0]
    return x ^ (x >> _U(32))


def grams(text: str | None, n: int) -> np.ndarray:
    """The set as sorted distinct hashes. Fewer words than ``n`` make one n-gram; none make none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_known.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = (out ^ (out >> _U(27))) * _ODD[1] + h[k : k + len(out)] * _ODD[2]
    return np.unique(_mix(out, _ODD[3]))


def _node(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _levels(size: int, rule: Rule) -> list[int]:
    """Size classes by powers of two. A set close below the next power is in the next class too,
    so that any two sets that can link by their sizes share a class."""
    level = size.bit_length() - 1
    return [level, level + 1] if 100 * size >= rule.percent << (level + 1) else [level]


def _sent(found: np.ndarray, level: int, rule: Rule) -> tuple[int, np.ndarray]:
    """How many n-grams count towards frequencies, and those with what else the prefix may need.

    Which do depends on the n-gram and the level alone, as an order must. The
    level is mixed into all but the 16 bits that this is read from.
    """
    share = 65536 if (1 << level) < SMALL else rule.sample
    chosen = (found & _U(0xFFFF)) < _U(share)
    counted, rest = found[chosen], found[~chosen]
    more = max(0, rule.prefix(len(found)) - len(counted))
    sent = np.concatenate([counted, rest[:more]]) ^ (_U(level * 0x9E3779B97F4B) << _U(16))
    return len(counted), sent


_ROWS = "doc_id bigint, n bigint, node binary, level int, counted int, sent array<bigint>, main boolean"


def _describe(rule: Rule) -> Batches:
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.bool_()]
    names = ["doc_id", "n", "node", "level", "counted", "sent", "main"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(lo, ROWS_AT_ONCE)
                at, out = [], []
                for i, text in enumerate(rows.column("text").to_pylist()):
                    found = grams(text, rule.n)
                    if not len(found):
                        at.append(i)
                        out.append((0, None, None, None, None, True))
                        continue
                    node = _node(found)
                    for k, level in enumerate(_levels(len(found), rule)):
                        counted, sent = _sent(found, level, rule)
                        at.append(i)
                        out.append((len(found), node, level, counted, sent.view(np.int64), k == 0))
                doc = rows.column("doc_id").take(pa.array(at, pa.int64()))
                columns = [pa.array([o[c] for o in out], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([doc, *columns], names)

    return run


def _sets(rule: Rule) -> Batches:
    """The set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                found = [grams(t, rule.n) for t in batch.slice(lo, ROWS_AT_ONCE).column("text").to_pylist()]
                nodes = pa.array([_node(g) for g in found], pa.binary())
                yield pa.RecordBatch.from_arrays([nodes, pa.array([g.tobytes() for g in found], pa.binary())], ["node", "grams"])

    return run


def _orders(rule: Rule) -> Batches:
    """The prefixes of each text's set under the two hash orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                found = [grams(t, rule.n) for t in batch.slice(lo, ROWS_AT_ONCE).column("text").to_pylist()]
                firsts = [
                    [_first(g, odd, int(rule.prefix(len(g)))).astype(np.uint32).tobytes() for g in found] for odd in _ODD[1:3]
                ]
                columns = [[_node(g) for g in found], *firsts]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["node", "second", "third"])

    return run


def _membership(lists: list[np.ndarray]) -> np.ndarray:
    """How many members any two lists share, by products of membership matrices, some columns at a time."""
    m = len(lists)
    shared = np.zeros((m, m), dtype=np.float32)
    owner = np.repeat(np.arange(m), [len(x) for x in lists])
    if not len(owner):
        return shared
    values = np.concatenate(lists)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(first) - 1
    common = (np.bincount(column) > 1)[column]  # what one list alone holds is shared with nobody
    owner, column = owner[common], np.cumsum(first & common)[common] - 1
    if not len(owner):
        return shared
    width = max(1, CELLS // m)
    for start in range(0, int(column[-1]) + 1, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        block = np.zeros((m, min(width, int(column[-1]) + 1 - start)), dtype=np.float32)
        block[owner[lo:hi], column[lo:hi] - start] = 1
        shared += block @ block.T
    return shared


def _first(found: np.ndarray, odd: np.uint64, size: int) -> np.ndarray:
    """The prefix under the hash order of ``odd``."""
    keys = _mix(found, odd)
    return np.partition(keys, size - 1)[:size] if 0 < size < len(keys) else keys


def _in_charge(level, leader, block, across, size, leaders, rule: Rule) -> np.ndarray:
    """Which pairs of a group can link by their sizes and are looked at here, in one group of one level only."""
    small, large = np.minimum.outer(size, size), np.maximum.outer(size, size)
    ok = 100 * small >= rule.percent * large
    ok &= np.not_equal.outer(block, block) if across else ~np.eye(len(size), dtype=bool)
    # The level of a pair is that of its larger set; below it no pair is looked at twice.
    ok &= large >= (1 << level)
    # Two rows meet in the group of every leader they share; the least of them is in charge.
    ok &= _membership([x[x < leader] for x in leaders]) == 0
    return ok


def _narrow(ok: np.ndarray, keep: Callable[[np.ndarray], np.ndarray]) -> None:
    """Intersect ``ok`` with ``keep(rows)``, worked out for the rows that still have a partner."""
    live = np.flatnonzero(ok.any(axis=1))
    if len(live):
        ok[np.ix_(live, live)] &= keep(live)


def _forest(ok: np.ndarray) -> np.ndarray:
    """The least row that each row reaches."""
    label = np.arange(len(ok))
    while True:
        lowest = np.where(ok, label[None, :], len(ok)).min(axis=1, initial=len(ok))
        new = np.minimum(label, lowest)
        new = new[new]
        if (new == label).all():
            return label
        label = new


_GROUP = ("level", "leader", "low", "high")
_LIVE = "node binary, level int, leader bigint, low bigint, high bigint, block bigint, n bigint, leaders array<bigint>"


def _by_group(work: Callable[[pa.Table], pa.Table | None]) -> Batches:
    """``work`` on each group of two rows or more. Rows come sorted by group; a group may lie in several batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        key = None

        def close() -> Iterator[pa.RecordBatch]:
            if sum(t.num_rows for t in held) > 1 and (out := work(pa.concat_tables(held).combine_chunks())) is not None:
                yield from out.to_batches()
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _GROUP])
            turns = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *turns], [*turns, batch.num_rows]):
                this = tuple(keys[:, lo])
                if this != key:
                    yield from close()
                    key = this
                held.append(pa.Table.from_batches([batch.slice(lo, hi - lo)]))
        yield from close()

    return run


def _lists(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.array(x, dtype=np.int64) for x in table.column(name).to_pylist()]


def _bytes(table: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=kind) for x in table.column(name).to_pylist()]


def _charge_of(table: pa.Table, rule: Rule) -> np.ndarray:
    level, leader, low, high = (table.column(c)[0].as_py() for c in _GROUP)
    block, size = table.column("block").to_numpy(), table.column("n").to_numpy()
    return _in_charge(level, leader, block, low != high, size, _lists(table, "leaders"), rule)


def _candidates(rule: Rule) -> Batches:
    """Rows of a group that share a prefix n-gram with one and the same other row under all three orders."""

    def work(table: pa.Table) -> pa.Table | None:
        ok = _charge_of(table, rule)
        if ok.any():
            firsts = (_lists(table, "prefix"), _bytes(table, "second", np.uint32), _bytes(table, "third", np.uint32))
            for prefixes in firsts:
                _narrow(ok, lambda live: _membership([prefixes[i] for i in live]) > 0)
        live = np.flatnonzero(ok.any(axis=1))
        return table.take(live).select([c.split()[0] for c in _LIVE.split(", ")]) if len(live) else None

    return _by_group(work)


def _verify(rule: Rule) -> Batches:
    def work(table: pa.Table) -> pa.Table | None:
        ok, size = _charge_of(table, rule), table.column("n").to_numpy()
        sets = _bytes(table, "grams", np.uint64)

        def alike(live: np.ndarray) -> np.ndarray:
            shared = _membership([sets[i] for i in live])
            union = np.add.outer(size[live], size[live]) - shared
            return 100 * shared.astype(np.int64) >= rule.percent * union.astype(np.int64)

        _narrow(ok, alike)
        linked = np.flatnonzero(ok.any(axis=1))
        if not len(linked):
            return None
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        return pa.table({"u": rep[linked], "v": rep[_forest(ok)[linked]], "n_links": ok[linked] @ copies})

    return _by_group(work)


def pick(rows: DataFrame, ids: DataFrame, on: list[str], how: str) -> DataFrame:
    """A semi or anti join that broadcasts the ids if they are few, and shuffles both sides if not."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids.hint("merge"), on, how)


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over edges ``u, v``."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, root``: the least id that each id of ``edges`` (``u, v``) reaches; roots themselves are left out."""

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = land(edges.where("u <> v").select("u", "v").distinct(), "jaccard-edges")
    before = state(edges)
    while before[0]:
        old, edges = edges, land(_star(edges), "jaccard-edges")
        discard(old)
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _sampled(gram: Column, rule: Rule) -> Column:
    share = F.when(F.col("level") < SMALL.bit_length() - 1, 65536).otherwise(rule.sample)
    return gram.bitwiseAND(F.lit(0xFFFF)) < share


def _frequent(listed: DataFrame) -> DataFrame:
    """N-grams with over ``1 / MOST_FREQUENT`` of the postings of a sample of rows: fewer than that many.

    Which they are decides only how postings travel, not what comes out.
    """
    chosen = listed.select("sent").sample(FREQUENT_SAMPLE, seed=0)
    total = chosen.agg(F.sum(F.size("sent"))).first()[0] or 0
    counted = chosen.select(F.explode("sent").alias("gram")).groupBy("gram").count()
    return land(counted.where(F.col("count") * MOST_FREQUENT > total).select("gram"), "jaccard-frequent")


def _shared(listed: DataFrame) -> DataFrame:
    """``key, gram, df, leader`` of postings whose n-gram several classes hold.

    ``df`` counts rows, copies too: the order only needs it to depend on the
    n-gram alone. Postings are shuffled once, by n-gram, and counted where they
    lie. Frequent n-grams would fill single tasks there; those are counted by
    partial aggregation and their counts broadcast back to the postings.
    """
    postings = listed.select("key", F.explode("sent").alias("gram"))
    count = {"df": F.count(F.lit(1)), "leader": F.min("key"), "last": F.max("key")}

    def looked_up(known: DataFrame) -> DataFrame:
        """Postings with a match in ``known`` or nulls, as many as before: a left join that stays one."""
        found = postings.join(F.broadcast(known.withColumn("often", F.lit(True))), "gram", "left")
        return found.withColumn("often", evaluate_once(F.coalesce("often", F.lit(False))))

    often = looked_up(_frequent(listed)).where("often")  # fewer than MOST_FREQUENT n-grams
    totals = often.groupBy("gram").agg(*[of.alias(name) for name, of in count.items()])
    told = looked_up(totals)
    by_gram = Window.partitionBy("gram")
    rare = told.where("NOT often").select("key", "gram", *[of.over(by_gram).alias(name) for name, of in count.items()])
    both = rare.unionByName(told.where("often").select("key", "gram", *count))
    return both.where("leader <> last").drop("last")


def link(docs: DataFrame, rule: Rule = Rule(), text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, n_links``.

    ``component_id`` is the least id reachable by links, the row's own included;
    ``n_links`` counts linked rows, equal sets among them. Null, empty and blank
    texts have no n-grams and no links. Rows without an id link with nothing and
    have a null component. Rows that share an id count as one document. Only
    ``doc_id`` and the text are read, so other columns cannot clash.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = land(source.mapInArrow(_describe(rule), _ROWS), "jaccard-rows")

    # Two numbers to a posting, as there are many: the class at its level, and the n-gram.
    listed = rows.where("node IS NOT NULL AND doc_id IS NOT NULL").withColumn("key", F.xxhash64("node", "level"))
    met = _shared(listed).groupBy("key").agg(F.collect_set(F.struct("df", "gram", "leader")).alias("met"))
    about = listed.groupBy("key", "node", "level").agg(F.first("n").alias("n"), F.first("counted").alias("counted"))
    ranked = F.sort_array(
        F.transform("met", lambda x: F.struct((~_sampled(x["gram"], rule)).alias("late"), x["df"].alias("df"), x["gram"].alias("gram"), x["leader"].alias("leader")))
    )
    held = met.join(about, "key")
    size = F.col("n") - F.ceil(F.col("n") * rule.percent / 100) + 1

    def first(g: Column) -> Column:
        # N-grams of this class alone come first in the order and take their part of the prefix.
        once = F.col("counted") - F.size(F.filter(g, lambda x: ~x["late"]))
        return bind(size - once, lambda room: F.filter(g, lambda x, i: x["late"] | (i < room)))

    live = held.select("node", "level", "n", bind(ranked, first).alias("g")).where(F.size("g") > 0)
    live = land(
        live.select(
            "node",
            "level",
            "n",
            F.col("g.gram").alias("prefix"),
            F.sort_array(F.array_distinct(F.col("g.leader"))).alias("leaders"),
        ),
        "jaccard-prefixes",
    )

    member = live.select("node", "level", "n", "prefix", "leaders", F.explode("leaders").alias("leader"))
    groups = member.groupBy("level", "leader").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("grams")).where("sets > 1")
    parts = F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("grams") / BLOCK_GRAMS)).cast("bigint")
    dealt = member.join(groups.select("level", "leader", parts.alias("parts")), ["level", "leader"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")))
    meeting = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    dealt = dealt.select("*", meeting.alias("other")).select(
        "node", "level", "leader", "n", "prefix", "leaders", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    dealt = land(dealt, "jaccard-meetings")

    # One row stands for each class: the texts of these are read again, the others are not.
    reps = rows.where("main AND node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    reps = land(reps, "jaccard-classes")

    def texts(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The classes of these nodes, landed, and the texts of the rows that stand for them."""
        taken = land(reps.join(nodes.select("node").distinct(), "node", "left_semi"), "jaccard-taking")
        ids = taken.select(F.col("rep").alias("doc_id")).distinct()
        return taken, pick(source, ids, ["doc_id"], "left_semi").select("text")

    def met_in_groups(rows: DataFrame) -> DataFrame:
        return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    # An id may have several texts; only wanted sets go on, each once.
    asked, asked_texts = texts(dealt)
    firsts = asked_texts.mapInArrow(_orders(rule), "node binary, second binary, third binary")
    firsts = firsts.groupBy("node").agg(F.first("second").alias("second"), F.first("third").alias("third"))
    passed = met_in_groups(dealt.join(firsts, "node")).select(
        *_GROUP, "node", "block", "n", "prefix", "leaders", "second", "third"
    )
    passed = land(passed.mapInArrow(_candidates(rule), _LIVE), "jaccard-candidates")

    taken, taken_texts = texts(passed)
    sets = taken_texts.mapInArrow(_sets(rule), "node binary, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))
    whole = met_in_groups(passed.join(taken.join(sets, "node"), "node")).select(
        *_GROUP, "block", "n", "leaders", "rep", "copies", "grams"
    )
    found = land(whole.mapInArrow(_verify(rule), "u bigint, v bigint, n_links bigint"), "jaccard-links")

    discard(live, dealt, asked, passed, taken)

    degree = found.groupBy(F.col("u").alias("rep")).agg(F.sum("n_links").alias("others"))
    roots = components(found).select(F.col("id").alias("rep"), "root")
    named = reps.join(roots, "rep", "left").join(degree, "rep", "left").select(
        "node",
        F.coalesce("root", "rep").alias("component"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )
    return _answer(rows, named)


def _answer(rows: DataFrame, named: DataFrame) -> DataFrame:
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.where("main").select("doc_id", "n", "node").join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
    )


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row of each component: that of its least id. Rows without an id stay.

    Where an id has several texts, rows are told apart by id and text, and the one
    with the least hash of both stays of each component.
    """
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(body).alias("a"), F.max(body).alias("b"))
    clash = not texts.where("a <> b").isEmpty()
    own = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")) if clash else F.col("doc_id").cast("bigint")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("doc_id"), F.col("text"))
    linked = land(link(rows.select("doc_id", "text"), rule).select("doc_id", "component_id"), "jaccard-components")
    dropped = land(linked.where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-dropped")
    left = pick(rows.select("row", "doc_id"), dropped, ["doc_id"], "left_anti")
    again = linked.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").select("doc_id")
    again = land(again, "jaccard-repeated")
    if not again.isEmpty():
        once = pick(left, again, ["doc_id"], "left_semi").dropDuplicates(["doc_id"])
        left = pick(left, again, ["doc_id"], "left_anti").unionByName(once)
    return left.select("row.*")
