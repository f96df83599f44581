"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds the 64-bit hashes of its distinct word shingles.  Equal
sets fall into one class at once.  Each class keeps ``SIGNATURE`` minwise
tokens (32-bit minima of random permutations).  Each of ``trees`` independent
trees branches the classes: a node chooses one token position, and a second
one with probability 1/threshold - 1, from its path alone, and a class follows
every chosen position to the child named by its minwise token there.  A pair
of similarity J stays together on a branch with probability J, and a node has
1/threshold branches on average, so a linked pair meets again in the mean
however deep the tree is; independent trees raise the recall.  Over sixteen trees a
pair at 0.85 is missed with a probability below 1e-5, at 0.8 (threshold 0.8)
below 3e-5, if it has to meet on all six levels and its signatures agree in
just that share; over the spread of 128 positions that all trees draw from it
is 6e-5 and 3e-4.  Pairs in nodes that are small after two levels: below 1e-7.

Sizes are looked at every second level.  A larger node of which half the
classes are as similar to one of them as linked documents (a group of near
copies; by sketches, see below) is branched no further.  Nodes of at most ``SMALL`` classes are
compared exhaustively.  Node rows carry one hashed bit of each minwise token;
a class whose bits rule out every other one in its node (more different bits
than a linked pair has, by 6 standard deviations) leaves the node before
anything is joined to it, so chance meetings of unlike texts cost no more.

Links are confirmed on the full sets, in two rounds.  The first takes only a
spanning forest of each small node (by sketches, where its rows are gathered), and the links to two pivots of each node
that stays large (thousands of near copies).  In the second, the members of a
small node that may still be linked across components bring their full sets to
one task, which counts all intersections at once and hands on only links that
join components, fewer than it has members; sets of more than ``CELL_BYTES``
in one node are dealt to cells of pairs of parts.  In a large node only
classes outside its largest component are compared, in blocks, with the whole
node.  So no link that joins two components is lost, and no pair of a small
node ever becomes a row unless it is a link.

Defined cases: texts without words have empty sets and are linked with
nothing; a text with fewer than ``WORDS`` words is one shingle; rows with a
null id take part only as copies (component null if nothing with an id is
linked); rows are judged one by one, also those that share an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wiremap.llm.common import by_bytes, id_text, sieve, stored
from wiremap.llm.components import components

SIGNATURE = 128
TREES = 16
SMALL = 128
LEVELS = 3
BLOCK = 2048
CELL_BYTES = 16 << 20
U64 = np.uint64
RECORD = "doc_id long, n_shingles long, digest binary, signature binary"


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit bijection that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_SEEDS = mix(np.arange(1, 2 * SIGNATURE + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
FACTORS = (_SEEDS[:SIGNATURE] >> U64(32)).astype(np.uint32) | np.uint32(1)
SHIFTS = (_SEEDS[SIGNATURE:] >> U64(32)).astype(np.uint32)


def ascii_lower(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """A-Z in lower case; every other byte stays (bytes of other characters are above 127)."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]].copy() if data else np.zeros(0, np.uint8)
    raw[(raw >= 65) & (raw <= 90)] |= 32
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(raw))


def shingle_sets(texts: pa.Array, words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (lower-cased A-Z, ASCII white space)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return []
    cut = pc.ascii_split_whitespace(ascii_lower(texts.cast(pa.large_string())))
    coded = cut.flatten().dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), U64, len(vocabulary))
    some = np.fromiter((bool(w) for w in vocabulary), bool, len(vocabulary))
    index = np.asarray(coded.indices)
    real = some[index] if len(index) else np.zeros(0, bool)
    h = hashes[index[real]] if len(index) else np.zeros(0, U64)
    offsets = np.asarray(cut.offsets)
    at = np.concatenate(([0], np.cumsum(real)))[offsets - offsets[0]]
    factor = U64(0x9E3779B97F4A7C15)
    rolled = h[:max(0, len(h) - words + 1)].copy()
    for k in range(1, words):
        rolled *= factor
        rolled += h[k:k + len(rolled)]
    rolled = mix(rolled)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes(), seed=b - a)], U64))
        else:
            out.append(np.zeros(0, U64))
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    x = (hashes >> U64(32)).astype(np.uint32)
    out = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        np.minimum(out, (x[i:i + 4096, None] * FACTORS + SHIFTS).min(0), out)
    return out


def sketch(sig: np.ndarray) -> np.ndarray:
    """One hashed bit of each minwise token: two 64-bit words a row."""
    return np.packbits((sig * np.uint32(0x9E3779B1)) >> np.uint32(31), axis=1).view(U64)


def different_bits(threshold: float) -> int:
    """The most bits in which the sketches of a linked pair differ."""
    same = (1 + threshold) / 2
    return int(SIGNATURE * (1 - same) + 6 * (SIGNATURE * same * (1 - same)) ** 0.5)


def records(docs: DataFrame, words: int) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text), as ``RECORD``."""

    def run(batches):
        for b in by_bytes(batches, "text", 4 << 20):
            sets = shingle_sets(b.column("text"), words)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "n_shingles", "digest", "signature"])

    return docs.mapInArrow(run, RECORD)


def branch(row: np.ndarray, node: np.ndarray, sig: np.ndarray,
           threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The children that the rows at these nodes follow their minwise tokens to."""
    t = U64(SIGNATURE)
    one = mix(node ^ U64(0x1D8E4E27C47D124F)) % t
    two = mix(node ^ U64(0xA24BAED4963EE407)) % t
    coin = (mix(node ^ U64(0x9FB21C651E98DF25)) >> U64(11)).astype(np.float64) / (1 << 53)
    also = (coin < 1 / threshold - 1) & (one != two)
    row = np.concatenate((row, row[also]))
    position = np.concatenate((one, two[also]))
    token = sig[row, position.astype(np.int64)].astype(U64)
    node = np.concatenate((node, node[also]))
    return row, mix(node + mix((position << U64(32)) | token))


def _descend(rows: DataFrame, trees: int, threshold: float, root: bool) -> DataFrame:
    """Two levels down: rows (node, rep, s, t) of the tree roots or of given nodes; s, t: sketch."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            for s in (b.slice(i, 2048) for i in range(0, b.num_rows, 2048)):
                sig = np.frombuffer(b"".join(s.column("signature").to_pylist()), np.uint32)
                sig = sig.reshape(-1, SIGNATURE)
                rep = s.column("rep").to_numpy()
                if root:
                    row = np.repeat(np.arange(len(rep)), trees)
                    node = np.tile(mix(np.arange(1, trees + 1, dtype=U64)), len(rep))
                else:
                    row, node = np.arange(len(rep)), s.column("node").to_numpy().view(U64)
                for _ in range(2):
                    row, node = branch(row, node, sig, threshold)
                bits = sketch(sig).view(np.int64)[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (node.view(np.int64), rep[row], bits[:, 0].copy(), bits[:, 1].copy())],
                    names=["node", "rep", "s", "t"])

    return rows.mapInArrow(run, "node long, rep long, s long, t long")


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows with their node's size, without nodes of one class."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
    return rows.join(sizes, "node")


def near_members(node: np.ndarray, rep: np.ndarray, bits: np.ndarray, most: int) -> np.ndarray:
    """Which rows, in order of nodes, have another class near them in their node."""
    out = np.zeros(len(node), bool)
    for step in range(1, len(node)):
        together = node[step:] == node[:-step]
        if not together.any():
            break
        a = np.flatnonzero(together)
        near = np.bitwise_count(bits[a] ^ bits[a + step]).sum(1) <= most
        a = a[near & (rep[a] != rep[a + step])]
        out[a] = out[a + step] = True
    return out


def forest(bits: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A minimum spanning forest over the pairs of rows that differ in at most ``most`` bits."""
    if len(bits) == 2:
        return [(0, 1)] if np.bitwise_count(bits[0] ^ bits[1]).sum() <= most else []
    apart = np.bitwise_count(bits[:, None] ^ bits).sum(2, dtype=np.int64)
    a, b = np.nonzero(np.triu(apart <= most, 1))
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    order = np.argsort(apart[a, b], kind="stable")
    for i, j in zip(a[order].tolist(), b[order].tolist()):
        x, y = find(i), find(j)
        if x != y:
            root[x] = y
            out.append((i, j))
            if len(out) == len(bits) - 1:
                break
    return out


def _near_lists(leaf: DataFrame, threshold: float) -> DataFrame:
    """The members of each small node that its sketches leave, sorted, and a forest of near pairs."""
    most = different_bits(threshold)

    def run(batches):
        for b in batches:
            rows = b.column("rows")
            flat = rows.flatten()
            rep, s, t = (np.asarray(flat.field(k)) for k in range(3))
            node = np.repeat(np.arange(len(rows)), pc.list_value_length(rows))
            bits = np.stack([s, t], 1).view(U64)
            keep = np.flatnonzero(near_members(node, rep, bits, most))
            lists, pairs = [], []
            for at in np.split(keep, np.flatnonzero(np.diff(node[keep])) + 1) if len(keep) else []:
                ids, first = np.unique(rep[at], return_index=True)
                lists.append(ids)
                pairs.append([{"a": int(ids[i]), "b": int(ids[j])} for i, j in forest(bits[at[first]], most)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists, pa.list_(pa.int64())),
                 pa.array(pairs, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                names=["members", "pairs"])

    rows = leaf.groupBy("node").agg(F.collect_list(F.struct("rep", "s", "t")).alias("rows"))
    return rows.select("rows").mapInArrow(run, "members array<long>, pairs array<struct<a: long, b: long>>")


def _alike(live: DataFrame, threshold: float) -> DataFrame:
    """The nodes of which half the classes are, by their sketches, as similar to a pivot as linked ones.

    Branching cannot split a group of near copies; it only repeats its rows.
    """
    pivots = live.groupBy("node").agg(F.min_by(F.struct("s", "t"), F.xxhash64("rep")).alias("pivot"))
    apart = F.bit_count(F.col("s").bitwiseXOR(F.col("pivot.s"))) + F.bit_count(
        F.col("t").bitwiseXOR(F.col("pivot.t")))
    share = live.join(pivots, "node").groupBy("node").agg(
        F.avg((apart <= SIGNATURE * (1 - threshold) / 2).cast("int")).alias("share"))
    return stored(share.filter("share >= 0.5").select("node"), "alike")


def nodes(reps: DataFrame, trees: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Leaf nodes: (small) distinct member lists, (large) rows (node, rep)."""
    small, live, large = None, None, None
    for level in range(LEVELS):
        # Only signatures that branch on are shuffled, not those of the whole corpus.
        source = reps.select("rep", "signature") if live is None else live.join(
            sieve(reps, "rep", live), "rep").select("node", "rep", "signature")
        # Written first, as sizes and rows both read it: no branch is followed twice.
        branches = stored(_descend(source, trees, threshold, live is None), "branches")
        found = stored(_grouped(branches), "nodes")
        leaf = _near_lists(found.filter(F.col("size") <= SMALL), threshold)
        small = leaf if small is None else small.unionByName(leaf)
        whole = found.filter(F.col("size") > SMALL)
        if level + 1 < LEVELS:
            alike = _alike(whole, threshold)
            live = whole.select("node", "rep").join(alike, "node", "left_anti")
            whole = whole.join(alike, "node", "left_semi")
        whole = whole.select("node", "rep")
        large = whole if large is None else large.unionByName(whole)
    lists = stored(small.filter(F.size("members") > 1).distinct()
                   .withColumn("list", F.xxhash64("members")), "lists")
    return lists, stored(large.distinct(), "large-nodes")


def estimates(sig: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Share of equal minwise tokens for all pairs of two signature blocks."""
    out = np.empty((len(sig), len(other)), np.float32)
    for i in range(len(sig)):
        out[i] = (sig[i] == other).mean(1)
    return out


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([min(p) for p in pairs], pa.int64()), pa.array([max(p) for p in pairs], pa.int64())],
        names=["a", "b"])


def _signatures(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint32).reshape(-1, SIGNATURE)


def first_pairs(lists: DataFrame, large: DataFrame) -> DataFrame:
    inside = lists.select(F.inline("pairs"))
    mark = F.xxhash64("rep")
    pivots = large.groupBy("node").agg(F.min("rep").alias("p"), F.min_by("rep", mark).alias("q"))
    stars = large.join(pivots, "node").select(F.explode(F.array("p", "q")).alias("p"), "rep")
    stars = stars.filter("p <> rep").select(F.least("p", "rep").alias("a"), F.greatest("p", "rep").alias("b"))
    return inside.unionByName(stars).distinct()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with the component of their class (rep)."""
    return rows.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of full sets are linked: all intersections by products of incidence rows."""
    n, sizes = len(sets), np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    code = np.where(shared[code], (np.cumsum(shared) - 1)[code], -1)
    both, width = np.zeros((n, n), np.int64), 1 << 16
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(code, (low, low + width))
        rows = np.zeros((n, width if low + width <= shared.sum() else int(shared.sum()) - low), np.float32)
        rows[owner[a:b], code[a:b] - low] = 1
        both += (rows @ rows.T).astype(np.int64)
    np.fill_diagonal(both, sizes)
    return 100 * both >= percent * (sizes[:, None] + sizes - both)


def small_links(lists: DataFrame, reps: DataFrame, sets: DataFrame, labels: DataFrame, cutoff: float,
                percent: int) -> DataFrame:
    """Links (a, b) between components inside small nodes, at most members - 1 a node."""

    def open_members(batches):
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for name, ids, raw, comp in zip(*(b.column(k).to_pylist() for k in ("list", "rep", "signature", "component"))):
                sig, comp = _signatures(raw), np.array(comp)
                near = ((estimates(sig, sig) >= cutoff) & (comp[:, None] != comp)).any(1)
                for i in np.flatnonzero(near).tolist():
                    for o, v in zip(out, (name, ids[i], int(comp[i]))):
                        o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out],
                                             names=["list", "rep", "component"])

    def judge(t: pa.Table) -> pa.Table:
        own, comp, ids = t["part"].to_numpy(), t["component"].to_pylist(), t["rep"].to_pylist()
        yes = np.triu(linked([np.frombuffer(x, U64) for x in t["hashes"].to_pylist()], percent), 1)
        if t["i"][0] != t["j"][0]:
            yes &= own[:, None] != own
        root: dict[int, int] = {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        out = []
        for i, j in zip(*np.nonzero(yes)):
            x, y = find(comp[i]), find(comp[j])
            if x != y:
                root[x] = y
                out.append((ids[i], ids[j]))
        return pa.Table.from_batches([_pair_batch(out)])

    # Signatures go only to nodes that lie in several components.
    rows = _labelled(lists.select("list", F.explode("members").alias("rep")), labels)
    rows = rows.groupBy("list").agg(F.collect_list(F.struct("rep", "component")).alias("rows"))
    rows = stored(rows.filter(F.size(F.array_distinct("rows.component")) > 1).select("list", F.inline("rows")),
                  "open-nodes")
    rows = rows.join(sieve(reps, "rep", rows), "rep").groupBy("list").agg(
        F.collect_list(F.struct("rep", "signature", "component")).alias("rows")).select(
            "list", "rows.rep", "rows.signature", "rows.component")
    rows = rows.mapInArrow(open_members, "list long, rep long, component long")
    rows = stored(rows, "open-members").join(sets, "rep")
    node = Window.partitionBy("list")
    before = F.sum(F.length("hashes")).over(node.orderBy("rep"))
    rows = rows.withColumn("part", F.floor((before - 1) / CELL_BYTES).cast("int"))
    rows = rows.withColumn("last", F.max("part").over(node)).withColumn(
        "other", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    rows = rows.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    found = rows.groupBy("list", "i", "j").applyInArrow(judge, "a long, b long")
    return stored(found.distinct(), "small-links")


def rest_pairs(large: DataFrame, reps: DataFrame, labels: DataFrame, cutoff: float) -> DataFrame:
    """Pairs in one large node and in different components that signatures don't rule out."""
    rows = stored(_labelled(large, labels), "labelled")
    sizes = rows.groupBy("node", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("node").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                     F.sum("n").alias("size"), F.max("n").alias("most"))
    main = main.filter("most < size").withColumns({
        "blocks": F.ceil(F.col("size") / BLOCK).cast("int"),
        "outside": F.ceil((F.col("size") - F.col("most")) / BLOCK).cast("int")})
    rows = stored(rows.join(main, "node"), "split-nodes")
    rows = rows.join(sieve(reps, "rep", rows), "rep").withColumn("at", F.xxhash64("rep"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.withColumn("i", F.pmod("at", "blocks").cast("int")).withColumn("j", spread("outside"))
    right = rows.filter("component <> main").withColumn("j", F.pmod("at", "outside").cast("int")).withColumn(
        "i", spread("blocks"))

    def blocks(x: pa.Table, y: pa.Table) -> pa.Table:
        out = []
        if x.num_rows and y.num_rows:
            sig, comp, ids = _signatures(x["signature"].to_pylist()), x["component"].to_numpy(), x["rep"].to_numpy()
            for raw, own, rep in zip(*(y[f"r_{c}"].to_pylist() for c in ("signature", "component", "rep"))):
                near = (sig == np.frombuffer(raw, np.uint32)).mean(1) >= cutoff
                out += [(rep, k) for k in ids[near & (comp != own)].tolist()]
        return pa.Table.from_batches([_pair_batch(out)])

    keep = ["node", "i", "j", "rep", "signature", "component"]
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in keep]).groupBy("r_node", "r_i", "r_j")
    outside = (left.select(*keep).groupBy("node", "i", "j").cogroup(right)
               .applyInArrow(blocks, "a long, b long"))
    return outside.distinct()


def wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows (doc_id, text) whose id is in ``wanted`` (distinct ids, which are never broadcast).

    Most texts share no node with another one; the sieve keeps them out of the shuffle.  The
    join is an inner one, as Spark would move a semi join before the sieve.
    """
    return sieve(docs, "doc_id", wanted).join(wanted.hint("merge"), "doc_id").select("doc_id", "text")


def full_sets(lists: DataFrame, large: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """The full sets (rep, hashes) of all classes that share a node with another one."""
    wanted = lists.select(F.explode("members").alias("doc_id")).unionByName(
        large.select(F.col("rep").alias("doc_id"))).distinct()

    def run(batches):
        for b in by_bytes(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(b.column("text"), words)],
                                              pa.binary())], names=["rep", "hashes"])

    return stored(wanted_texts(docs, wanted).mapInArrow(run, "rep long, hashes binary"), "sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets."""

    def judge(batches):
        for b in batches:
            same = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    both = pairs.join(sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y")), "b").join(
        sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x")), "a")
    return stored(both.select("a", "b", "x", "y").mapInArrow(judge, "a long, b long"), "confirmed")


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = 5, trees: int = TREES,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, n_shingles, component_id, kept.

    Links join documents with 100 * intersection >= ``percent`` * union of
    their shingle sets; component_id is the smallest id that links reach.
    """
    threshold = percent / 100
    cutoff = threshold - 6 * (threshold * (1 - threshold) / SIGNATURE) ** 0.5
    rows = id_text(docs, id_col, text_col)
    all_rows = stored(records(rows, words), "records")
    some = all_rows.filter("digest is not null")
    classes = some.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = stored(some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
                  .filter("rep is not null").select("rep", "signature"), "classes")
    lists, large = nodes(reps, trees, threshold)
    pairs = stored(first_pairs(lists, large), "pairs")
    sets = full_sets(lists, large, rows, words)
    links = confirm(pairs, sets, percent)
    labels = stored(components(links), "components")
    links = links.unionByName(small_links(lists, reps, sets, labels, cutoff, percent))
    more = stored(rest_pairs(large, reps, labels, cutoff).join(pairs, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(confirm(more, sets, percent))
    labels = components(links)
    known = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id"))
    # Rows with empty sets keep out of the join, or they would meet in one task.
    found = some.join(known, "digest").select("doc_id", "n_shingles", "component_id")
    alone = all_rows.filter("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
