"""N-gram Jaccard self-join with signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from islet.llm.common import WORD, enter, keep, leave
from islet.llm.components import components
from islet.llm.textarrays import U, mix, shingles

SHARE, OF = 75, 100  # two sets link when OF * |both| >= SHARE * |either|
EXACT_UPTO, EXACT_FROM = 96, 72  # sets of up to EXACT_UPTO have all their prefix as keys; those from EXACT_FROM on have KEYS minima
KEYS = 24
COMMON, MOST_COMMON = 64, 200_000
BLOCK = 1024
MOST_BITS = 1 << 17
_SALTS = mix(np.arange(1, KEYS + 1, dtype=U)) | U(1)


def _need(a, b):
    """Least overlap of linked sets of these sizes, times SHARE + OF."""
    return SHARE * (a + b)


def _bitmap(tokens: np.ndarray) -> bytes:
    """At least 4 bits a token, a power of two, MOST_BITS at most."""
    bits = min(MOST_BITS, max(64, 1 << int(4 * len(tokens) - 1).bit_length()))
    flags = np.zeros(bits, bool)
    flags[(tokens & U(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _keys(tokens: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, int]:
    """Routing keys such that linked sets share one, and how many tokens are common.

    Small sets: their prefix in one global order with common tokens last, so sharing is certain. Large
    sets: KEYS minima of independent orders over the tokens that aren't common, and over all tokens
    if more than half are common; linked sets miss each with a chance of a quarter to a half, all of
    them with 0.25**24 to 0.5**24.
    """
    n = len(tokens)
    if not n:
        return tokens, 0
    frequent = common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens if len(common) else np.zeros(n, bool)
    hot = int(frequent.sum())
    out = []
    if n <= EXACT_UPTO:
        order = np.lexsort((tokens * _SALTS[0], frequent))
        out.append(mix(tokens[order[: n - (SHARE * n + OF - 1) // OF + 1]]))
    if n >= EXACT_FROM:
        for some, salt in ((tokens[~frequent], 1), (tokens if hot and 2 * hot > n else tokens[:0], 2)):
            if len(some):
                out += [mix(np.array([(some * s).min() + U(salt)])) + s for s in _SALTS]
    return np.unique(np.concatenate(out)), hot


def _local_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens in three or more different texts of a batch, with how many."""
    for batch in batches:
        texts = {t for t in batch.column(0).to_pylist() if t}
        sets = [shingles(t) for t in texts]
        if sets:
            token, n = np.unique(np.concatenate(sets), return_counts=True)
            some = n >= 3
            yield pa.RecordBatch.from_arrays([pa.array(token[some].view(np.int64)), pa.array(n[some])], ["token", "n"])


def _sets(common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(2).to_pylist():
                tokens = shingles(t)
                keys, hot = _keys(tokens, common)
                rows.append((len(tokens), _digest(tokens), hot, keys.view(np.int64), _bitmap(tokens)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.list_(pa.int64())), pa.array([r[4] for r in rows], pa.binary())],
                ["row", "spot", "n", "id", "hot", "keys", "bits"],
            )

    return run


def _digest(tokens: np.ndarray) -> int:
    """A set's identity: its sorted 64-bit tokens and their number, in 64 bits."""
    if not len(tokens):
        return 0
    place = mix(np.arange(1, len(tokens) + 1, dtype=U)) | U(1)
    return int(mix(np.array([(mix(tokens) * place).sum() + U(len(tokens))])).view(np.int64)[0])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, tokens as bytes), once for each id of a batch."""
    for batch in batches:
        texts = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.int64()), pa.array([shingles(t).tobytes() for t in texts.values()], pa.binary())], ["id", "tokens"])


def _linked_sets(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
    return OF * both >= SHARE * (len(x) + len(y) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, tokens of a, tokens of b) -> the links among them."""
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3)):
            ok.append(_linked_sets(*(np.frombuffer(v.as_buffer(), U) for v in (x, y))))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _matrix(sets: list[np.ndarray]) -> np.ndarray:
    """One row of bits (as 64-bit words) a set, a bit each for the values that two or more sets have."""
    value, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(n > 1) - 1
    flags = np.zeros((len(sets), max(64, -(-int((n > 1).sum()) // 64) * 64)), bool)
    who = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    some = n[at] > 1
    flags[who[some], place[at[some]]] = True
    return np.packbits(flags, axis=1, bitorder="little").view(U)


class Tree:
    """A signature tree: levels of nodes with OR-combined bitmaps, size ranges, most tokens beyond the bits, and components."""

    def __init__(self, bits: np.ndarray, size: np.ndarray, excess: np.ndarray, root: np.ndarray):
        self.levels = [(bits, size, size, excess, root, np.ones(len(size), bool))]
        while len(self.levels[0][0]) > 1:
            bits, low, high, excess, root, one = self.levels[0]
            if len(bits) % 2:  # an odd last node has itself as its twin
                bits, low, high, excess, root, one = (np.concatenate([v, v[-1:]]) for v in (bits, low, high, excess, root, one))
            even, odd = slice(0, None, 2), slice(1, None, 2)
            self.levels.insert(0, (bits[even] | bits[odd], np.minimum(low[even], low[odd]), np.maximum(high[even], high[odd]), np.maximum(excess[even], excess[odd]), root[even], one[even] & one[odd] & (root[even] == root[odd])))


def traverse(one: Tree, other: Tree | None) -> tuple[np.ndarray, np.ndarray]:
    """Leaves in different components that may link, by dual traversal from the roots, or of a tree against itself."""
    same, two = other is None, other or one
    depth = max(len(one.levels), len(two.levels))
    level = lambda t, d: t.levels[max(0, d - depth + len(t.levels))]
    x = y = np.zeros(1, np.int64)
    for d in range(depth):
        a, b = level(one, d), level(two, d)
        ok = ~(a[5][x] & b[5][y] & (a[4][x] == b[4][y]))
        ok &= (OF * a[2][x] >= SHARE * b[1][y]) & (OF * b[2][y] >= SHARE * a[1][x])
        x, y = x[ok], y[ok]
        most, step = np.zeros(len(x), np.int64), max(1, (1 << 22) // a[0].shape[1])
        for i in range(0, len(x), step):
            most[i : i + step] = np.bitwise_count(a[0][x[i : i + step]] & b[0][y[i : i + step]]).sum(1, dtype=np.int64)
        most += np.minimum(a[3][x], b[3][y])
        ok = (SHARE + OF) * most >= _need(a[1][x], b[1][y])
        x, y = x[ok], y[ok]
        if d == depth - 1:
            break
        grow = lambda t, v: (np.stack([2 * v, 2 * v + 1]) if d + 1 - depth + len(t.levels) > 0 else np.stack([v, v]))
        gx, gy = grow(one, x), grow(two, y)
        x, y = np.concatenate([gx[i] for i in (0, 0, 1, 1)]), np.concatenate([gy[j] for j in (0, 1, 0, 1)])
        ok = (x < len(level(one, d + 1)[1])) & (y < len(level(two, d + 1)[1]))
        if same:
            ok &= x <= y
        x, y = x[ok], y[ok]
        if len(one.levels) != len(two.levels) and len(x):  # a shorter tree's root meets the other's nodes once
            x, y = np.unique(np.stack([x, y]), axis=1)
    return (x[x != y], y[x != y]) if same else (x, y)


def _sides(rows: list[dict]) -> tuple[list[dict], list[dict]]:
    """A group's rows at its two sides, siblings of the tree near each other; an empty second side: the first against itself."""
    rows = sorted(rows, key=lambda r: (r["root"], r["n"], r["id"]))
    return [r for r in rows if not r["side"]], [r for r in rows if r["side"]]


def _trees(first: list[dict], second: list[dict], bits: np.ndarray, excess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (by number in first + second) that the trees leave."""
    rows, k = first + second, len(first)
    size, root = np.array([r["n"] for r in rows]), np.array([r["root"] for r in rows])
    made = [Tree(bits[s], size[s], excess[s], root[s]) for s in (slice(0, k), slice(k, None)) if len(rows[s])]
    x, y = traverse(made[0], made[1] if second else None)
    return x, y + k if second else y


def _few(first: list[dict], second: list[dict]) -> Iterator[tuple[int, int]]:
    """As _trees by hashed bitmaps, for groups of two or three."""
    rows, k = first + second, len(first)
    for i, j in [(i, j) for i in range(k) for j in (range(k, len(rows)) if second else range(i + 1, k))]:
        p, q = rows[i], rows[j]
        if p["root"] != q["root"] and OF * min(p["n"], q["n"]) >= SHARE * max(p["n"], q["n"]):
            w = max(len(p["bits"]), len(q["bits"]))
            u, v = (int.from_bytes(r["bits"] * (w // len(r["bits"])), "little") for r in (p, q))
            excess = min(r["n"] - int.from_bytes(r["bits"], "little").bit_count() for r in (p, q))
            if (SHARE + OF) * ((u & v).bit_count() + excess) >= _need(p["n"], q["n"]):
                yield i, j


def _survivors(rows: list[dict]) -> list[tuple]:
    """(key, pair, side, id) of the members that keep a partner; a pair counts at the least key that it shares."""
    first, second = _sides(rows)
    rows = first + second
    if not first or not second and len(first) < 2:
        return []
    key = rows[0]["key"]
    if len(rows) <= 3:
        alive = {i for p in _few(first, second) if min({*rows[p[0]]["keys"]} & {*rows[p[1]]["keys"]}) == key for i in p}
    else:
        words = max(len(r["bits"]) for r in rows) // 8
        bits = np.stack([np.tile(b := np.frombuffer(r["bits"], U), words // len(b)) for r in rows])
        own = np.array([int(np.bitwise_count(np.frombuffer(r["bits"], U)).sum()) for r in rows])
        x, y = _trees(first, second, bits, np.array([r["n"] for r in rows]) - own)
        lower = _matrix([(k := np.array(r["keys"], np.int64))[k < key] for r in rows])
        alive, step = set(), 1 << 16
        for i in range(0, len(x), step):
            new = ~(lower[x[i : i + step]] & lower[y[i : i + step]]).any(1)
            alive.update(x[i : i + step][new].tolist(), y[i : i + step][new].tolist())
    return [(key, rows[i]["pair"], rows[i]["side"], rows[i]["id"]) for i in alive]


def _forest(rows: list[dict]) -> list[tuple]:
    """Links (a, b) among a group's members that join components, as many as it takes and no more; by trees of exact bitmaps."""
    first, second = _sides(rows)
    rows = first + second
    if not first or not second and len(first) < 2:
        return []
    sets = [np.frombuffer(r["tokens"], U) for r in rows]
    if sum(map(len, sets)) * len(sets) < 1 << 31:
        # a bit for each token that two members share: what the trees leave is linked
        x, y = _trees(first, second, _matrix(sets), np.zeros(len(sets), np.int64))
        pairs = zip(x.tolist(), y.tolist())
    else:
        # sets too large to lay out: pair by pair, fitting sizes only
        k = len(first)
        pairs = ((i, j) for i in range(k) for j in (range(k, len(rows)) if second else range(i + 1, k)) if OF * min(len(sets[i]), len(sets[j])) >= SHARE * max(len(sets[i]), len(sets[j])))
        pairs = (p for p in pairs if rows[p[0]]["root"] != rows[p[1]]["root"] and _linked_sets(sets[p[0]], sets[p[1]]))
    up = {r["root"]: r["root"] for r in rows}

    def top(v):
        while up[v] != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    out = []
    for i, j in pairs:
        a, b = top(rows[i]["root"]), top(rows[j]["root"])
        if a != b:
            up[a] = b
            out.append((rows[i]["id"], rows[j]["id"]))
    return out


def _by_group(what, names: list[str]):
    """Runs ``what`` on the rows of each (key, pair), which come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, out = [], []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(len(names))], names)
        for batch in batches:
            for row in batch.to_pylist():
                if rows and (row["key"], row["pair"]) != (rows[0]["key"], rows[0]["pair"]):
                    out += what(rows)
                    rows = []
                    if len(out) > 100_000:
                        yield pack()
                        out = []
                rows.append(row)
        out += what(rows) if rows else []
        yield pack()

    return run


def _texts_tokens(ids: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, tokens) of some classes; only their own documents' texts meet them, once each."""
    used = ids.join(classes.select("id", "spot"), "id")
    return keep(docs.join(used, "spot").select("id", "text").mapInArrow(_tokens, "id long, tokens binary"))


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their exact sets."""
    tokens = _texts_tokens(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, classes)
    x, y = (tokens.select(F.col("id").alias(k), F.col("tokens").alias(f"t{k}")) for k in "ab")
    return pairs.join(x, "a").join(y, "b").select("a", "b", "ta", "tb").mapInArrow(_verify, "a long, b long").distinct()


def _components(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, list[str], DataFrame]:
    """The input with row (tells texts apart) and spot (tells documents apart), and per row with shingles its set size and component's root."""
    flat, names = enter(docs, doc_id=doc_id, text=text)
    flat = flat.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    # row tells texts apart, spot documents
    flat = flat.withColumn("row", F.xxhash64("text", F.length("text"))).withColumn("spot", F.xxhash64("row", "doc_id"))
    texts = flat.select("row", "spot", "text")
    # The hot tokens only order the keys: any set of them gives the same links, so its size can be fixed.
    counts = texts.select("text").mapInArrow(_local_counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    common = np.sort(np.array([r.token for r in counts.orderBy(F.desc("n"), "token").limit(MOST_COMMON).select("token").collect()], np.int64).view(U))
    sets = keep(texts.mapInArrow(_sets(common), "row long, spot long, n long, id long, hot long, keys array<long>, bits binary"))
    classes = sets.where("n > 0").groupBy("id").agg(F.min("spot").alias("spot"), F.max("n").alias("n"), F.max("hot").alias("hot"))
    routed = keep(sets.where("n > 0").select(F.explode("keys").alias("key"), "id", "n", "hot").distinct())

    # the hub of a key: the member with the largest part of common tokens, as the origin of many copies has it
    rank = F.struct((F.col("hot") / F.col("n")).alias("r"), "id")
    hubs = routed.groupBy("key").agg(F.max(rank).alias("hub"), F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("key", F.col("hub.id").alias("hub"))
    shared = keep(routed.join(hubs, "key"))
    best = shared.where("id <> hub").groupBy("id", "hub").agg(F.count("*").alias("k"), F.max("n").alias("n"))
    best = best.where(F.col("k") >= F.least(F.lit(4), F.greatest(F.lit(1), F.floor(F.col("n") / 12)))).groupBy("id").agg(F.max(F.struct("k", "hub")).alias("best"))
    first = best.select(F.greatest("id", "best.hub").alias("a"), F.least("id", "best.hub").alias("b")).distinct()
    links = keep(_linked(first, texts, classes))
    roots = components(links)

    members = shared.select("key", "id", "n").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    parts = members.groupBy("key", "root").agg(F.count("*").alias("m"), F.min("n").alias("low"), F.max("n").alias("high"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("m", "root")).alias("main"), F.sum("m").alias("all"), F.count("*").alias("parts"), F.max("low").alias("lows"), F.min("high").alias("highs"))
    # two parts can't link when the smaller sizes of one and the larger of the other are too far apart
    mixed = mixed.where(F.col("parts") > 1).where((F.col("parts") > 2) | (OF * F.col("highs") >= SHARE * F.col("lows")))
    mixed = mixed.select("key", F.col("main.root").alias("main"), F.ceil(F.col("main.m") / BLOCK).alias("mains"), F.ceil((F.col("all") - F.col("main.m")) / BLOCK).alias("rests"))
    dealt = members.join(mixed, "key").withColumn("is_main", F.col("root") == F.col("main"))
    # rest blocks are 0 .. rests-1, main blocks rests .. rests+mains-1; a pair of blocks is (i, j), i <= j, i a rest block
    own = F.when(F.col("is_main"), F.col("rests") + F.pmod(F.xxhash64("id"), "mains")).otherwise(F.pmod(F.xxhash64("id"), "rests"))
    dealt = dealt.withColumn("own", own).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("is_main"), F.col("rests") - 1).otherwise(F.col("rests") + F.col("mains") - 1))))
    pair = F.least("own", "i") * (F.col("rests") + F.col("mains")) + F.greatest("own", "i")
    dealt = keep(dealt.select("key", pair.alias("pair"), F.when(F.col("own") > F.least("own", "i"), 1).otherwise(0).alias("side"), "id", "n", "root"))
    own = sets.join(dealt.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.first("bits").alias("bits"), F.first("keys").alias("keys"))
    together = lambda rows: rows.repartition("key", "pair").sortWithinPartitions("key", "pair")
    alive = together(dealt.join(own, "id")).mapInArrow(_by_group(_survivors, ["key", "pair", "side", "id"]), "key long, pair long, side long, id long")
    alive = keep(alive.distinct().join(dealt, ["key", "pair", "side", "id"]))
    tokens = _texts_tokens(alive.select("id").distinct(), texts, classes)
    more = keep(together(alive.join(tokens, "id")).mapInArrow(_by_group(_forest, ["a", "b"]), "a long, b long"))
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))

    of_class = sets.where("n > 0").select("row", "id", F.col("n").alias("n_shingles")).distinct()
    return flat, names, of_class.join(roots.withColumnRenamed("node", "id"), "id", "left").select("row", "n_shingles", F.coalesce("root", "id").alias("root"))


def jaccard_join(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Links documents whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

    Adds n_shingles (set size) and component_id (the smallest doc_id reachable by links, itself
    included). Words are the runs of anything but ASCII blanks, A-Z lower-cased; a text of fewer than five
    words has one shingle, one without words or a null text none, and links with nothing.

    1. Equal sets form classes; from here on a class is one row. Sets and tokens are told apart by 64-bit hashes.
    2. Routing: each class gets a few dozen keys; linked classes share one (see ``_keys``). Tokens of many
       documents come last in the order, so a passage that a third of the corpus shares makes no hot key.
    3. Each class is checked against one hub, the best of its keys, and components are taken: this
       settles nearly all of each near-copy group without looking at its pairs.
    4. Signature trees complete this: of each key whose members are still in different components, blocks of
       up to 1024 members form trees, blocks are paired (not those of the key's main component among
       themselves), and dual traversal prunes node pairs in one component, with sizes too far apart or with too
       small a maximum overlap. Members that keep a partner meet again with their whole sets, in trees whose bitmaps have a
       bit for each shared token, so that what these leave is linked; of such links a spanning forest goes on, and
       components are taken anew.

    Repeated rows and equal texts each come back, in one class. Rows of one doc_id with different texts are
    different documents that carry the same id. A null doc_id is a document that never gives a component its
    id; a component of nulls only has a null id. Input columns named like an added column are replaced.
    """
    flat, names, member = _components(docs, doc_id, text)
    # each side is written, so that the joins have shuffles of their own, which adaptive execution can split at a large component or a text of many copies
    member = keep(member.join(flat.groupBy("row").agg(F.min("doc_id").alias("least")), "row"))
    roots = keep(member.groupBy("root").agg(F.min("least").alias("component_id")))
    known = keep(member.join(roots, "root").select("row", "n_shingles", "component_id"))
    done = flat.join(known, "row", "left")
    empty = F.col("n_shingles").isNull()
    return leave(done, names, {"n_shingles": F.coalesce("n_shingles", F.lit(0).cast("long")), "component_id": F.when(empty, F.col("doc_id")).otherwise(F.col("component_id"))})


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component of ``jaccard_join`` the document with the smallest doc_id (nulls last; then by a hash of the text), once.

    Documents without shingles are in no component and all stay. Only ids and hashes meet by component; texts are
    shuffled once, by a key that copies don't share.
    """
    flat, names, member = _components(docs, doc_id, text)
    told = flat.select("row", "spot", "doc_id").join(member, "row")
    chosen = told.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "spot")).alias("best")).select("best.spot")
    some = flat.where(F.col("text").rlike(WORD))
    first = Window.partitionBy("spot").orderBy(F.lit(1))
    kept = some.join(chosen, "spot", "left_semi").withColumn("nth", F.row_number().over(first)).where("nth = 1")
    return leave(kept, names, {}).unionByName(leave(flat.where(~F.col("text").rlike(WORD)), names, {}))
