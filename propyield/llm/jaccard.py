"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document's set holds its distinct 5-word shingles (hashed to 64 bits); two documents
link when 100 * |A n B| >= 80 * |A u B|.

1. Shingles that many documents share are found by counting within tasks; they come
   last in the global order of shingles (a bounded table; it moves work, not results).
2. Each set keeps a prefix of |A| - ceil(0.8 |A|) + 1 shingles in that order: linked
   sets share one of them. Documents with the same prefix and size form one group, and
   only groups are posted under their prefix shingles. Documents with the same set
   are one node, never compared.
3. Groups that meet under a shingle are filtered by size and by the number of prefix
   shingles they share (a link needs more than their suffixes can hold). First each
   meets the smallest group of the list only (and each member the leader of its
   group): a list of copies costs as many pairs as it has members. Verified links give
   components; a link that this round misses is found in the next. A list of a frequent
   shingle has several such groups, chosen by hash; while lists still hold so many
   documents outside their largest component that meeting all others would cost far
   more than the lists are long, these meet a few newly chosen ones first.
4. What may still be missing are links between different components: lists that hold
   more than one component are expanded to members, and those outside the list's
   largest component meet all others of a fitting size, under shingles whose places in
   both prefixes allow them to be the first common one of a link. Pairs within a component
   are never listed, so a group of near copies is not squared, and no link is lost.
5. All pairs are verified exactly on whole sets, which are computed again from the
   texts for candidates alone.

Defined cases: a null or blank text has the empty set (n_shingles 0), links with
nothing and is its own component; with fewer than five words the whole sequence is
the one shingle; a row without an id takes part by its text, but its id is never the
smallest of a component (a component without any id has a null one); rows that share an
id but not a text are judged each by its own text; equal rows give equal rows; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propyield.llm.common import fresh, map_batches, small_batches, words_of
from propyield.session import scratch_path

SHINGLE = 5
#: A link: intersection >= LINK percent of the union.
LINK = 80
#: Frequent shingles that are put last, at most; a task names those that it saw
#: HOT_SEEN times within CHUNK shingles.
HOT, HOT_SEEN, CHUNK = 1 << 19, 4, 2_000_000
#: Members of a long list that all others meet first, and rounds (the last is exact) as long
#: as the last step would list more than COSTLY pairs for each row of the lists.
PIVOTS, ROUNDS, COSTLY = 5, 2, 30
#: Bits of the filter that spares most documents without candidates the last pass.
FILTER_BITS = 25

#: Word hashes that a worker remembers before it starts anew.
REMEMBERED = 1 << 18

_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    """64-bit hashes of words, remembered within a task up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes | None, hashes: dict) -> np.ndarray:
    """The sorted distinct 64-bit shingle hashes of a whole text."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(w))
    n = len(w) - size + 1
    h = w[:n].copy()
    for j in range(1, size):
        h = h * _MULTIPLY + w[j:j + n]
    return np.unique(_mixed(h + np.uint64(size)))


def prefix_length(size: int) -> int:
    return size - (size * LINK + 99) // 100 + 1 if size else 0


def _signature(values: np.ndarray, size: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(values.tobytes(), seed=size) - (1 << 63)


def frequent_shingles(docs: DataFrame, limit: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents hold (sorted), and their rank by frequency."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def seen(parts: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.concatenate(parts or [np.zeros(0, dtype=np.uint64)])
        parts.clear()
        tokens.sort()
        # equal ones stand together: those as long as HOT_SEEN, and how far each goes
        first = np.flatnonzero(tokens[HOT_SEEN - 1:] == tokens[:len(tokens) - HOT_SEEN + 1]) if len(tokens) >= HOT_SEEN else np.zeros(0, dtype=np.int64)
        often = np.unique(tokens[first])
        n = np.searchsorted(tokens, often, side="right") - np.searchsorted(tokens, often)
        return pa.RecordBatch.from_arrays([pa.array(often.view(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, parts, held = _WordHashes(), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                parts.append(shingle_set(text, hashes))
                held += len(parts[-1])
            if held > CHUNK:
                yield seen(parts)
                parts, held = [], 0
        yield seen(parts)

    counts = (docs.select(F.col("text").cast("binary")).mapInArrow(run, "token long, n long")
              .groupBy("token").agg(F.sum("n").alias("n"))
              .withColumn("grade", F.floor(F.log2("n") * 8).cast("int")))
    path = scratch_path(docs.sparkSession, "jaccard-frequent")
    counts.write.parquet(path)
    counts = docs.sparkSession.read.parquet(path)
    taken, floor = 0, None
    for r in counts.groupBy("grade").agg(F.count(F.lit(1)).alias("w")).orderBy(F.desc("grade")).collect():
        taken += r["w"]
        if taken > limit:
            break
        floor = r["grade"]
    if floor is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    got = counts.where(F.col("grade") >= floor).select("token", "n").toArrow()
    tokens = got["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    rank = np.empty(len(tokens), dtype=np.int64)
    rank[np.lexsort((tokens, got["n"].to_numpy()))] = np.arange(len(tokens))
    return tokens[order], rank[order]


def _prefixes(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, rid, size, node (set), gid (prefix and size), rare and often: the prefix shingles."""
    spread = docs.sparkSession.sparkContext.broadcast(hot)
    hashes = _WordHashes()

    def fn(ids, rids, texts):
        tokens, rank = spread.value
        out: dict[str, list] = {c: [] for c in ("doc_id", "rid", "size", "node", "gid", "rare", "often")}
        for i, rid, text in zip(ids, rids, texts, strict=True):
            s = shingle_set(text, hashes)
            n = prefix_length(len(s))
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                is_hot = tokens[at] == s
                rare, often = s[~is_hot][:n], s[is_hot]
                often = often[np.argsort(rank[at[is_hot]])][:n - len(rare)]
            else:
                rare, often = s[:n], s[:0]
            out["doc_id"].append(i)
            out["rid"].append(rid)
            out["size"].append(len(s))
            out["node"].append(_signature(s, len(s)) if len(s) else None)
            out["gid"].append(_signature(np.concatenate([rare, often]), len(s)) if len(s) else None)
            out["rare"].append(rare.view(np.int64))
            out["often"].append(often.view(np.int64))
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "rid", F.col("text").cast("binary")), fn,
                       f"doc_id {kind}, rid long, size long, node long, gid long, rare array<long>, often array<long>")


def _fits(a, b):
    """The size filter: linked sets differ in size by a fifth at most."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * LINK


def _enough(shared, a, b):
    """Whether sets of sizes ``a`` and ``b`` with ``shared`` common prefix shingles may link.

    Of the two prefixes, one ends first in the global order: common shingles up to its
    end are in both prefixes, all others in that set's suffix. So the intersection is
    at most ``shared`` plus the longer suffix, and a link needs 80/180 of both sizes.
    """
    suffix = F.floor((F.greatest(a, b) * LINK + 99) / 100) - 1
    return (shared + suffix) * (100 + LINK) >= (a + b) * LINK


def _may_link(pa, sa, pb, sb):
    """The positional filter: whether a common shingle at places ``pa`` and ``pb`` of sets of
    sizes ``sa`` and ``sb`` can be the first one of a link.

    A link needs at least 80/180 of both sizes in common, and no common shingle stands
    before the first one. So every linked pair passes at its first common shingle.
    """
    need = F.floor(((sa + sb) * LINK + 99 + LINK) / (100 + LINK))
    return (pa <= sa - need + 1) & (pb <= sb - need + 1)


def _sharing_enough(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole prefixes share enough shingles for a link."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    held = (prefixes.join(wanted, "node", "left_semi").dropDuplicates(["node"])
            .select("node", "size", F.concat("rare", "often").alias("prefix")))
    side = lambda x: held.select(F.col("node").alias(x), F.col("size").alias(f"s{x}"), F.col("prefix").alias(f"p{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(_enough(F.size(F.array_intersect("pa", "pb")), F.col("sa"), F.col("sb"))).select("a", "b")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"jaccard-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _lists(prefixes: DataFrame) -> DataFrame:
    """token, gid, size, pos, pivot, pivot_size: postings of shingles that several groups
    share; ``pos`` is the shingle's place in the group's prefix, from 1.

    Frequent shingles may have very long lists: their groups are made distinct and their
    smallest group found by partial aggregation, and a join that splits large
    partitions brings it back. The lists of all others are short, and a window finds
    which of them hold more than one group.
    """
    posted = prefixes.where("node is not null")
    rare = posted.select(F.posexplode("rare").alias("pos", "token"), "gid", "size").withColumn("pos", F.col("pos") + 1)
    each = Window.partitionBy("token")
    rare = (rare.withColumn("first", F.min(F.struct("gid", "size")).over(each))
            .withColumn("last", F.max("gid").over(each)).where(F.col("first.gid") < F.col("last"))
            .select("token", "gid", "size", "pos", F.col("first.gid").alias("pivot"), F.col("first.size").alias("pivot_size")))
    before = F.size("rare") + 1
    often = (posted.select(F.posexplode("often").alias("at", "token"), "gid", "size", before.alias("before"))
             .select("token", "gid", "size", (F.col("at") + F.col("before")).alias("pos")).distinct())
    first = (often.groupBy("token").agg(_chosen("gid", 0).alias("pivots"), F.min("gid").alias("one"), F.max("gid").alias("last"))
             .where("one < last").select("token", F.explode(F.array_distinct("pivots")).alias("p"))
             .select("token", F.col("p.id").alias("pivot"), F.col("p.size").alias("pivot_size")))
    return rare.unionByName(often.join(first, "token"))


def _chosen(name: str, salt: int):
    """An aggregate: PIVOTS (id, size), each the one of the smallest hash under a salt."""
    smallest = [F.min(F.struct(F.xxhash64(F.lit(salt + i), name).alias("h"), F.col(name).alias("id"), "size"))
                for i in range(PIVOTS)]
    return F.array(*[F.struct(m["id"].alias("id"), m["size"].alias("size")) for m in smallest])


def _marks(ids: DataFrame) -> np.ndarray:
    """A bitmap of row keys: 2 ** FILTER_BITS bits, whatever their number."""
    at = F.pmod("rid", F.lit(1 << FILTER_BITS))
    words = (ids.select(at.alias("at"))
             .select(F.shiftright("at", 5).cast("int").alias("word"),
                     F.expr("shiftleft(1L, cast(at & 31 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    marks = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    marks[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return marks


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets link.

    Sets are computed from the texts of the nodes' documents alone, and meet in joins.
    """
    spark = docs.sparkSession
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes, "node")
    spread = spark.sparkContext.broadcast(_marks(wanted.select("rid")))
    hashes = _WordHashes()

    def sets(ids, at, texts):
        marks = spread.value
        at = np.array(at, dtype=np.int64)
        hit = np.flatnonzero((marks[at >> 5] >> (at & 31).astype(np.uint32)) & 1) if len(at) else []
        found = [shingle_set(texts[i], hashes) for i in hit]
        return {"rid": [ids[i] for i in hit], "tokens": [s.tobytes() for s in found],
                "node": [_signature(s, len(s)) if len(s) else None for s in found]}

    at = F.pmod("rid", F.lit(1 << FILTER_BITS))
    found = map_batches(docs.select("rid", at, F.col("text").cast("binary")), sets, "rid long, tokens binary, node long")
    sets_of = _written(found.where("node is not null"), "sets")

    def check(a, b, x, y):
        keep = []
        for i in range(len(a)):
            p, q = np.frombuffer(x[i], dtype=np.uint64), np.frombuffer(y[i], dtype=np.uint64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            if 100 * common >= LINK * (len(p) + len(q) - common):
                keep.append(i)
        return {"a": [a[i] for i in keep], "b": [b[i] for i in keep]}

    # the row stands for its node: of equal sets only that one takes part
    side = lambda df, node, tokens: df.select(
        F.col("node").alias(node), F.col("rid").alias(f"d{node}"), *[F.col("tokens").alias(t) for t in tokens])
    both = (pairs.join(side(nodes, "a", []), "a").join(side(nodes, "b", []), "b")
            .join(side(sets_of, "a", ["x"]), ["a", "da"]).join(side(sets_of, "b", ["y"]), ["b", "db"]))
    return map_batches(both.select("a", "b", "x", "y"), check, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, comp: the smallest node that links reach, for every node of ``links`` (a, b).

    Each round takes the smallest label among neighbours and then the label of that
    label, so chains halve; labels are written each round, which cuts the lineage.
    """
    both = _written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = _written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("comp").alias("far"))
        new = _written(step.join(jump, "to").select(
            "node", F.least("to", "far").alias("comp"), (F.least("to", "far") < F.col("comp")).alias("moved")), "labels")
        labels = new.select("node", "comp")
        if new.where("moved").isEmpty():
            return labels


def _open_lists(lists: DataFrame, members: DataFrame, comps: DataFrame) -> DataFrame:
    """token, share, pos, node, size, comp: the members of lists that hold several components.

    A group is a list of its own: its members share the whole prefix, whichever of its
    shingles are listed (``share`` is then larger than any prefix, and ``pos`` the first place).
    """
    comp_of = _written(members.join(comps, "node", "left")
                       .select("gid", "node", "size", F.coalesce("comp", "node").alias("comp")), "components")
    in_group = comp_of.groupBy("gid").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"))
    posted = lists.select("token", "gid", "pos").distinct()
    mixed = (posted.join(in_group, "gid").groupBy("token")
             .agg(F.min("c1").alias("c1"), F.max("c2").alias("c2")).where("c1 < c2").select("token"))
    groups = in_group.where("c1 < c2").select(F.col("gid").alias("token"), "gid", F.lit(1 << 40).alias("share"), F.lit(1).alias("pos"))
    chosen = posted.join(mixed, "token").select("token", "gid", F.lit(1).cast("long").alias("share"), "pos").unionByName(groups)
    return _written(chosen.join(comp_of, "gid").select("token", "share", "pos", "node", "size", "comp"), "open")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every input row."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # rows are told apart by a hash of id and text, so those without an id take part too
    docs = docs.withColumn("rid", F.xxhash64("doc_id", "text"))
    prefixes = _written(_prefixes(docs, frequent_shingles(docs)), "prefixes")
    narrow = prefixes.select("doc_id", "rid", "size", "node", "gid")
    known = narrow.where("node is not null")
    members = _written(known.groupBy("gid", "node", "size").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("doc_id")), "members")
    nodes = members.select("node", "rid")
    leaders = members.groupBy("gid").agg(F.min("node").alias("leader"))
    lists = _written(_lists(prefixes), "lists")

    # each group meets the smallest of its list, each member the leader of its group
    meet = (lists.where((F.col("gid") != F.col("pivot")) & _fits(F.col("size"), F.col("pivot_size")))
            .groupBy("gid", "pivot", "size", "pivot_size").agg(F.count(F.lit(1)).alias("shared"))
            .where(_enough(F.col("shared"), F.col("size"), F.col("pivot_size"))).select("gid", "pivot"))
    meet = (meet.join(leaders, "gid").withColumnRenamed("leader", "a")
            .join(leaders.select(F.col("gid").alias("pivot"), F.col("leader").alias("b")), "pivot").select("a", "b"))
    inside = members.join(leaders, "gid").where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    ordered = lambda p: p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    first = _written(ordered(meet.union(inside)), "pairs")
    links = _written(_verified(first, docs, nodes), "linked")
    comps = components(links)

    done = first
    for salt in range(1, ROUNDS + 1):
        open_lists = _open_lists(lists, members, comps)
        counts = open_lists.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n"))
        largest = (counts.groupBy("token").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("n"))
                   .select("token", F.col("m.comp").alias("top"), "n", (F.col("n") - F.col("m.n")).alias("out")))
        cost = largest.agg(F.coalesce(F.sum(F.col("out") * F.col("n")), F.lit(0)).alias("pairs"),
                           F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
        minor = (open_lists.join(largest.select("token", "top"), "token").where("comp <> top")
                 .select("token", "share", F.col("pos").alias("pa"), F.col("node").alias("a"), F.col("size").alias("sa"),
                         F.col("comp").alias("ca"), "top"))
        last = salt == ROUNDS or cost["pairs"] <= COSTLY * cost["rows"]
        met = F.coalesce((F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("top")) | (F.col("a") < F.col("b"))), F.lit(True))
        fits = (F.col("a") != F.col("b")) & _fits(F.col("sa"), F.col("sb"))
        if last:
            # all links that can be missing: those outside a list's largest component meet all
            # others of a fitting size where the shingle can be their first common one
            other = open_lists.select("token", F.col("pos").alias("pb"), F.col("node").alias("b"), F.col("size").alias("sb"), F.col("comp").alias("cb"))
            first_common = _may_link(F.col("pa"), F.col("sa"), F.col("pb"), F.col("sb"))
            again = minor.join(other, "token").where(fits & met & first_common)
            again = again.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            again = _sharing_enough(_written(again.join(done, ["a", "b"], "left_anti"), "met"), prefixes)
        else:
            other = (open_lists.groupBy("token").agg(_chosen("node", salt * PIVOTS).alias("pivots"))
                     .select("token", F.explode(F.array_distinct("pivots")).alias("p"))
                     .select("token", F.col("p.id").alias("b"), F.col("p.size").alias("sb"), F.lit(None).cast("long").alias("cb")))
            again = minor.join(other, "token").where(fits & met)
            again = (again.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("sa") + F.col("sb")).alias("sum"),
                                   F.greatest("sa", "sb").alias("large")).agg(F.sum("share").alias("shared"))
                     .where(_enough(F.col("shared"), F.col("large"), F.col("sum") - F.col("large"))).select("a", "b"))
        pairs = _written(again.join(done, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            more = _written(_verified(pairs, docs, nodes), "linked")
            done = done.unionByName(pairs)
            if not more.isEmpty():
                links = links.unionByName(more)
                comps = components(links)
        if last:
            break

    whole = (members.select("node", "doc_id").join(comps, "node", "left").select("node", "doc_id", F.coalesce("comp", "node").alias("comp")))
    smallest = whole.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_node = whole.join(smallest, "comp").groupBy("node").agg(F.min("component_id").alias("component_id"))
    return narrow.join(by_node, "node", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id.

    Rows are told apart by their id and a 64-bit hash of their text, so texts that share
    an id are judged each by its own component; rows without an id come after all others.
    Documents without words stay; of rows that share an id and a text with words one stays.
    """
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    row = F.struct(id_.isNull().alias("absent"), id_.alias("id"), F.xxhash64(text.cast("binary")).alias("hash"))
    comp = _written(ngram_components(docs.select(row.alias("doc_id"), text.alias("text"))), "result")
    comp = comp.where("n_shingles > 0")
    key, gone = fresh("row"), fresh("gone")
    # the parts of a row's key, an id that is null on both sides being the same one
    keyed = docs.withColumn(key, row)
    match = (F.col(f"{key}.hash") == F.col(f"{gone}.hash")) & F.col(f"{key}.id").eqNullSafe(F.col(f"{gone}.id"))
    left_out = comp.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(gone)).distinct()
    kept = keyed.join(left_out, match, "left_anti")
    twice = (comp.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias(gone))
             .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(gone))
    if not twice.isEmpty():
        kept = kept.join(twice, match, "left_anti").unionByName(kept.join(twice, match, "left_semi").dropDuplicates([key]))
    return kept.drop(key)
