"""Near-duplicate components by an inverted join on MinHash signatures.

A text is the set of its distinct word shingles, and equal sets are one class. A class is posted
under each coordinate of its signature with the value there; classes that meet
under enough coordinates are compared on their full sets.

* Prefix merging: values that one class alone holds are dropped, then each class
  keeps its rarest values, all but ``matches - 1`` of those it shares. Two classes with
  ``matches`` values in common meet under one of these.
* Skip merging: the long lists, those of frequent values, are not merged. Collisions
  are counted by probing the signatures of classes that met.
* Hubs: a list of n classes is not expanded into pairs. Each class is compared with
  the most central class of its lists (the one whose values are the most frequent),
  which links copies of one original in a star. Only what that leaves apart is
  compared further: classes of one hub block against block, in tasks that give back links
  alone; classes of different hubs pair by pair in a list of at most ``LIST`` classes,
  in a longer one block against block, in tasks that give back pairs with enough matches alone.

A coordinate joins two minima, so sets of similarity s agree in it with probability
s * s. At 0.8 they share 31 of 48 on average, with a deviation of 3.3; fewer than 14 have
a probability below 1e-6. ``enough_matches`` gives that count for other thresholds. After that
sets are compared in full. A shingle is 62 bits of a polynomial of hashes of its words, and a class
128 bits of the SHA-256 of its sorted shingles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from . import rolling

WORDS = 5  # of a shingle
SIMILARITY = 80  # percent
COORDINATES = 48  # of a signature; each joins the minima of two hash functions
MISS = 5e-7  # probability, at most, that a pair at the threshold is not compared
SLOTS = 1 << 22  # of the filter for texts whose sets are compared
LIST = 64  # classes of a list that is expanded into pairs
BLOCK_CLASSES = 2_000  # of a side of two blocks of a longer list that are compared in one task
BLOCK_SHINGLES = 500_000  # of a side of two blocks of a hub that are compared in one task
HUB_CLASSES = 500  # of such a side

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, (COORDINATES, 2, 2), dtype=np.uint64)
_SEEDS[:, :, 1] |= np.uint64(1)


def shingles(chunk: rolling.Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of ``n`` words, by row and hash."""
    data = _LOWER[chunk.data]
    words = rolling.runs(chunk, _WORD[data])
    hashes = rolling.spans_hash(rolling.bytes_prefix(data), words.starts, words.ends)
    at, keys = rolling.windows(hashes, words, n)
    rows = words.row[at]
    counts = np.diff(words.first)
    for few in range(1, n):  # texts of fewer words: the whole sequence
        short = np.flatnonzero(counts == few)
        if len(short):
            at, more = rolling.windows(hashes, words, few)
            own = words.row[at]
            mine = counts[own] == few
            rows, keys = np.concatenate((rows, own[mine])), np.concatenate((keys, more[mine]))
    order = np.argsort(keys)
    small = rows.astype(np.uint16 if chunk.rows < 1 << 16 else np.int64)
    order = order[np.argsort(small[order], kind="stable")]
    rows, keys = rows[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], keys[new]


def signatures(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows with shingles, set sizes, both halves of the digest, and the coordinates as one number each."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    sizes = np.diff(starts, append=len(rows))
    tokens = np.empty((len(starts), COORDINATES), np.uint64)
    for c in range(COORDINATES):
        minima = [np.minimum.reduceat((keys ^ x) * a, starts) for x, a in _SEEDS[c]]
        tokens[:, c] = rolling.mix(rolling.mix(minima[0]) + minima[1] + np.uint64(c))
    one, two = digests(keys, starts)
    return rows[starts], sizes, one, two, tokens


def digests(keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of 128 bits that tell sets of sorted shingles apart."""
    ends = [*starts[1:].tolist(), len(keys)]
    hashed = [hashlib.sha256(keys[s:e]).digest()[:16] for s, e in zip(starts.tolist(), ends)]
    halves = np.frombuffer(b"".join(hashed), np.int64).reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


def enough_matches(percent: int) -> int:
    """Coordinates that two texts must share to be compared: as many as a pair at the
    threshold shares but for a probability of ``MISS``."""
    agree, below, count = (percent / 100) ** 2, 0.0, 0
    while count < COORDINATES:
        below += math.comb(COORDINATES, count) * agree**count * (1 - agree) ** (COORDINATES - count)
        if below >= MISS:
            break
        count += 1
    if count < 1:
        raise ValueError(f"{COORDINATES} coordinates are too few for a similarity of {percent} percent")
    return count


def _signed(docs: DataFrame, text: str, keep: list[str], words: int) -> DataFrame:
    """``keep`` columns with set size, digests and signature; empty sets have neither."""
    made = [("n_shingles", T.LongType()), ("_one", T.LongType()), ("_two", T.LongType()),
            ("_tokens", T.ArrayType(T.LongType()))]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(*m) for m in made])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sizes, one, two = (np.zeros(n, np.int64) for _ in range(3))
            tokens, filled = [], []
            for chunk in rolling.chunks(batch.column(batch.num_columns - 1)):
                rows, keys = shingles(chunk, words)
                if len(rows):
                    own, size, first, second, values = signatures(rows, keys)
                    own = own + chunk.first
                    sizes[own], one[own], two[own] = size, first, second
                    tokens.append(values)
                    filled.append(own)
            lengths = np.zeros(n, np.int64)
            if filled:
                lengths[np.concatenate(filled)] = COORDINATES
            flat = np.concatenate(tokens).ravel() if tokens else np.zeros(0, np.uint64)
            ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(sizes), pa.array(one), pa.array(two)]
            yield pa.RecordBatch.from_arrays([*columns, lists], schema.names)

    return docs.select(*keep, F.col(f"`{text}`").alias("_text")).mapInArrow(work, schema)


def _sets(docs: DataFrame, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """``_one``, ``_two``, ``_set``: digests and sorted shingles of the wanted texts, and of some more.

    Texts are told apart by ``SLOTS`` bits of their digest, a broadcast of that size at
    most, so that neither texts nor sets are shuffled to find out which are wanted; the
    caller joins on the digests. Of equal sets in a batch, one goes on.
    """
    schema = "_one long, _two long, _set array<long>"
    slot = F.pmod("_one", F.lit(SLOTS)).cast("int").alias("slot")
    slots = wanted.select(slot).distinct().toArrow()["slot"].to_numpy()  # at most SLOTS
    flags = np.zeros(SLOTS, bool)
    flags[slots] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(flags).tobytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        for batch in batches:
            met: set[tuple[int, int]] = set()
            for chunk in rolling.chunks(batch.column(0)):
                rows, keys = shingles(chunk, words)
                if len(rows):
                    starts = np.flatnonzero(np.diff(rows, prepend=-1))
                    one, two = digests(keys, starts)
                    ends = np.append(starts, len(keys)).astype(np.int32)
                    sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64)))
                    new = known[one % SLOTS]
                    for i in np.flatnonzero(new).tolist():
                        own = (int(one[i]), int(two[i]))
                        new[i] = own not in met
                        met.add(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one), pa.array(two), sets], ["_one", "_two", "_set"]
                    ).filter(pa.array(new))

    return docs.select(F.col(f"`{text}`").alias("_text")).mapInArrow(work, schema)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each node of ``a``, ``b`` edges reaches.

    Large and small stars take turns; each round is written, and minima are combined
    before they are shuffled, so a node with very many neighbours is no burden.
    """
    current = stage(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(
            both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "minima"
        )
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = stage(
            large.filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct(),
            "large",
        )
        least = stage(down.groupBy("a").agg(F.min("b").alias("m")), "minima")
        moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = stage(
            moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges"
        )
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def _similar(inter, left, right, percent: int):
    return F.lit(100) * inter >= F.lit(percent) * (left + right - inter)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar."""
    left = sets.select(F.col("_row").alias("a"), F.col("_set").alias("_left"))
    right = sets.select(F.col("_row").alias("b"), F.col("_set").alias("_right"))
    inter = F.size(F.array_intersect("_left", "_right"))
    enough = _similar(inter, F.size("_left"), F.size("_right"), percent)
    return pairs.join(left, "a").join(right, "b").filter(enough).select("a", "b")


def _meeting(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """The pairs whose signatures collide often enough, counted by probing them."""
    left = classes.select(F.col("_row").alias("a"), F.col("_tokens").alias("_left"))
    right = classes.select(F.col("_row").alias("b"), F.col("_tokens").alias("_right"))
    met = F.size(F.array_intersect("_left", "_right")) >= matches
    return pairs.join(left, "a").join(right, "b").filter(met).select("a", "b")


def _within_hubs(
    placed: DataFrame, sets: DataFrame, percent: int, block_shingles: int
) -> DataFrame:
    """Links between classes of one hub that are in different components.

    ``placed`` has ``_row``, ``hub``, ``comp``, ``n_shingles``. In each hub the largest component
    is one side, all else the other; blocks of bounded size are compared, the other
    side with everything.
    """
    sizes = placed.groupBy("hub", "comp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total")
    )
    main = sizes.groupBy("hub").agg(
        F.max(F.struct("n", "comp"))["comp"].alias("main"),
        F.count(F.lit(1)).alias("comps"),
    )
    inner = F.col("comp") == F.col("main")
    blocks = lambda side: F.greatest(
        F.lit(1),
        F.ceil(F.sum(F.when(side, F.col("total"))) / block_shingles),
        F.ceil(F.sum(F.when(side, F.col("n"))) / HUB_CLASSES),
    ).cast("int")
    sides = stage(
        sizes.join(main.filter("comps > 1"), "hub")
        .groupBy("hub", "main")
        .agg(blocks(inner).alias("_in"), blocks(~inner).alias("_out")),
        "sides",
    )
    rows = placed.join(sides, "hub").withColumn("_outer", F.col("comp") != F.col("main"))
    own = F.pmod(
        F.xxhash64("_row"), F.when(F.col("_outer"), F.col("_out")).otherwise(F.col("_in"))
    ).cast("int")
    # a task is (outer block, other block); other blocks are the outer ones, then the inner ones
    outer = F.sequence(F.lit(0), F.col("_out") - 1)
    tasks = F.when(
        F.col("_outer"),
        F.concat(
            F.transform(outer, lambda o: F.struct(F.greatest(o, own).alias("x"), F.least(o, own).alias("y"))),
            F.transform(
                F.sequence(F.lit(0), F.col("_in") - 1),
                lambda i: F.struct(own.alias("x"), (F.col("_out") + i).alias("y")),
            ),
        ),
    ).otherwise(
        F.transform(outer, lambda o: F.struct(o.alias("x"), (F.col("_out") + own).alias("y")))
    )
    dealt = rows.select("hub", "_row", "comp", F.explode(tasks).alias("t"), (
        F.when(F.col("_outer"), own).otherwise(F.col("_out") + own)).alias("block"))
    dealt = dealt.select("hub", F.col("t.x").alias("x"), F.col("t.y").alias("y"), "block", "comp", "_row")
    with_sets = dealt.join(sets, "_row").select("hub", "x", "y", "block", "comp", "_row", "_set")

    def work(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rows, comp = (group[c].to_numpy() for c in ("_row", "comp"))
        lists = group["_set"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        lengths = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy()
        starts = np.cumsum(lengths) - lengths
        _, ids = np.unique(values, return_inverse=True)
        mark = np.zeros(len(ids) and int(ids.max()) + 1, np.int64)
        found_a, found_b = [], []
        first = group["block"].to_numpy() == group["x"].to_numpy()
        for i in np.flatnonzero(first):
            mine = ids[starts[i] : starts[i] + lengths[i]]
            mark[mine] = 1
            inter = np.add.reduceat(mark[ids], starts)
            mark[mine] = 0
            good = 100 * inter >= percent * (lengths + lengths[i] - inter)
            good &= comp != comp[i]
            found_a.extend([rows[i]] * int(good.sum()))
            found_b.extend(rows[good])
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return with_sets.groupBy("hub", "x", "y").applyInArrow(work, "a long, b long")


def _within_lists(spots: DataFrame, classes: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs ``a``, ``b`` of a list, of different hubs and components, that match often enough.

    ``spots`` has ``token``, ``n``, ``_row``, ``hub``, ``comp``, ``n_shingles``. Blocks of bounded
    size are compared with each other, and no other pair leaves a task.
    """
    blocks = F.ceil(F.col("n") / BLOCK_CLASSES).cast("int")
    own = F.pmod(F.xxhash64("_row"), blocks).cast("int")
    tasks = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda o: F.struct(F.greatest(o, own).alias("x"), F.least(o, own).alias("y")),
    )
    columns = ["_row", "hub", "comp", "n_shingles", "block"]
    dealt = spots.withColumn("block", own).select("token", F.explode(tasks).alias("t"), *columns)
    dealt = dealt.select("token", F.col("t.x").alias("x"), F.col("t.y").alias("y"), *columns)
    signed = dealt.join(classes.select("_row", "_tokens"), "_row")

    def work(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rows, hub, comp, size, block = (group[c].to_numpy() for c in columns)
        lists = group["_tokens"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        lengths = np.diff(lists.offsets.to_numpy())
        _, ids = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        ends = np.cumsum(lengths)
        y = block == group["y"].to_numpy()
        other = np.flatnonzero(y)
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(other):
            theirs = ids[np.repeat(y, lengths)]
            starts = np.cumsum(lengths[other]) - lengths[other]
            mark = np.zeros(int(ids.max()) + 1, np.int64)
            same = group["x"][0].as_py() == group["y"][0].as_py()
            for i in np.flatnonzero(block == group["x"].to_numpy()):
                mine = ids[ends[i] - lengths[i] : ends[i]]
                mark[mine] = 1
                good = np.add.reduceat(mark[theirs], starts) >= matches
                mark[mine] = 0
                with_ = other[good]
                apart = (hub[with_] != hub[i]) & (comp[with_] != comp[i])
                least, most = np.minimum(size[with_], size[i]), np.maximum(size[with_], size[i])
                with_ = rows[with_[apart & (100 * least >= percent * most)]]
                with_ = with_[with_ > rows[i]] if same else with_
                found_a.append(np.minimum(with_, rows[i]))
                found_b.append(np.maximum(with_, rows[i]))
        return pa.table({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})

    return signed.groupBy("token", "x", "y").applyInArrow(work, "a long, b long")


def _class_links(
    docs: DataFrame, classes: DataFrame, text: str, words: int, percent: int, matches: int,
    block_shingles: int,
) -> DataFrame:
    """Links ``a``, ``b`` between classes, enough of them to give the components.

    ``classes`` has ``_row``, ``n_shingles``, ``_one``, ``_two``, ``_tokens`` of one row a class.
    """
    posts = classes.select("_row", F.explode("_tokens").alias("token"))
    shared = stage(posts.groupBy("token").count().filter("count > 1"), "shared")
    met = F.sort_array(F.collect_list(F.struct("count", "token")))
    posted = (
        posts.join(shared, "token")
        .groupBy("_row")
        .agg(met.alias("_met"), F.sum("count").alias("central"))
        .filter(F.size("_met") >= matches)
        .select(
            "_row",
            "central",
            F.transform("_met", lambda m: m["token"]).alias("_tokens"),
            F.slice(F.transform("_met", lambda m: m["token"]), F.lit(1), F.size("_met") - (matches - 1)).alias("_prefix"),
        )
    )
    posted = stage(posted, "posted")
    lists = posted.select("_row", "central", F.explode("_prefix").alias("token"))
    hubs = stage(
        lists.groupBy("token").agg(F.max(F.struct("central", "_row")).alias("_hub")), "hubs"
    )
    near = (
        lists.join(hubs, "token")
        .select(F.col("_row").alias("a"), F.col("_hub._row").alias("b"), F.col("_hub.central").alias("c"))
        .distinct()
    )
    near = stage(near, "near")
    met_hub = stage(_meeting(near.filter("a <> b").select("a", "b"), posted, matches), "met")

    # the full sets of classes that meet any other
    wanted = classes.join(posted.select("_row"), "_row", "left_semi").select("_row", "_one", "_two")
    wanted = stage(wanted, "wanted")
    sets = stage(
        _sets(docs, text, words, wanted)
        .join(wanted, ["_one", "_two"])
        .dropDuplicates(["_row"])
        .select("_row", "_set"),
        "sets",
    )
    links = stage(_links(met_hub, sets, percent), "links")
    comp = components(links).select(F.col("node").alias("_row"), F.col("root").alias("comp"))

    passed = met_hub.join(near, ["a", "b"]).unionByName(near.filter("a = b"))
    primary = passed.groupBy(F.col("a").alias("_row")).agg(F.max(F.struct("c", "b"))["b"].alias("hub"))
    placed = stage(
        posted.select("_row")
        .join(classes.select("_row", "n_shingles"), "_row")
        .join(primary, "_row", "left")
        .join(comp, "_row", "left")
        .select(
            "_row",
            "n_shingles",
            F.coalesce("hub", "_row").alias("hub"),
            F.coalesce("comp", "_row").alias("comp"),
        ),
        "placed",
    )
    # classes of different hubs that meet in a list
    spots = lists.select("_row", "token").join(placed, "_row")
    mixed = (
        spots.groupBy("token")
        .agg(F.min("hub").alias("h"), F.max("hub").alias("g"), F.min("comp").alias("c"), F.max("comp").alias("d"), F.count(F.lit(1)).alias("n"))
        .filter("h <> g and c <> d")
        .select("token", "n")
    )
    spots = stage(spots.join(stage(mixed, "mixed"), "token"), "spots")
    short = spots.filter(F.col("n") <= LIST)
    x, y = (short.select(*(F.col(c).alias(f"{side}{c}") for c in short.columns)) for side in "xy")
    apart = (F.col("xhub") != F.col("yhub")) & (F.col("xcomp") != F.col("ycomp"))
    sized = (100 * F.least("xn_shingles", "yn_shingles")) >= percent * F.greatest("xn_shingles", "yn_shingles")
    across = (
        x.join(y, (F.col("xtoken") == F.col("ytoken")) & (F.col("x_row") < F.col("y_row")) & apart & sized)
        .select(F.col("x_row").alias("a"), F.col("y_row").alias("b"))
        .distinct()
    )
    blocked = _within_lists(spots.filter(F.col("n") > LIST), posted, percent, matches)
    across = _meeting(across, posted, matches).unionByName(blocked).distinct()
    more = _links(stage(across, "across"), sets, percent)
    inner = _within_hubs(placed, sets, percent, block_shingles)
    return links.unionByName(more).unionByName(inner)


def link(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = SIMILARITY,
    text: str = "text",
    key: str = "doc_id",
    matches: int | None = None,
    block_shingles: int = BLOCK_SHINGLES,
    row: str | None = None,
) -> DataFrame:
    """Per document: ``key``, ``n_shingles``, ``component_id``, ``kept``, and ``_row``.

    Documents are linked if their sets of distinct shingles (lower case, words
    between white space) are similar by ``percent``; a text of fewer words
    is one shingle. ``component_id`` is the smallest key reachable. NULL and empty texts
    have no shingles and are linked with nothing. Repeated rows are documents of their
    own; a component whose keys are all NULL has a NULL id and keeps its documents.
    ``matches`` coordinates must agree before sets are compared; unless given, they follow
    from ``percent`` by ``enough_matches``, which raises where a signature is too short.
    ``_row`` identifies a row: the column named by ``row``, else one made here. Columns
    besides these are not read, whatever their names.
    """
    matches = enough_matches(percent) if matches is None else matches
    named = docs.select(
        F.col(f"`{key}`").alias("_key"),
        F.col(f"`{text}`").alias("_text"),
        *([F.col(f"`{row}`").alias("_row")] if row else []),
    )
    signed = _signed(named, "_text", [c for c in named.columns if c != "_text"], words)
    if not row:
        signed = signed.withColumn("_row", F.monotonically_increasing_id())
    signed = stage(signed, "signatures")
    reps = stage(
        signed.filter("n_shingles > 0").groupBy("_one", "_two").agg(F.min("_row").alias("_rep")), "classes"
    )
    classes = signed.join(reps.select(F.col("_rep").alias("_row")), "_row", "left_semi")
    classes = stage(classes, "representatives")
    links = _class_links(named, classes, "_text", words, percent, matches, block_shingles)
    roots = components(links).select(F.col("node").alias("_rep"), F.col("root").alias("_root"))
    roots = stage(reps.join(roots, "_rep", "left").select("_one", "_two", F.coalesce("_root", "_rep").alias("_root")), "roots")
    placed = (
        signed.drop("_tokens")
        .join(roots, ["_one", "_two"], "left")
        .select(
            "_key", "_row", "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("_root")).otherwise(F.col("_row")).alias("_root"),
        )
    )
    least = stage(placed.groupBy("_root").agg(F.min("_key").alias("component_id")), "components")
    return placed.join(least, "_root").select(
        F.col("_key").alias(key),
        "n_shingles",
        "component_id",
        F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"),
        "_root",
        "_row",
    )


def dedup(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = SIMILARITY,
    text: str = "text",
    key: str = "doc_id",
    matches: int | None = None,
) -> DataFrame:
    """The documents, with all their columns, without all but one of each component.

    The one with the smallest key stays (of several such rows, the first; NULL keys
    come last). Documents without words stay, as they are linked with nothing. ``matches``
    is that of ``link``.
    """
    matches = enough_matches(percent) if matches is None else matches
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")  # names can't clash
    rows = stage(docs.select(whole, F.monotonically_increasing_id().alias("_row")), "documents")
    named = rows.select(
        F.col(f"_doc.`{key}`").alias("_id"), F.col(f"_doc.`{text}`").alias("_body"), "_row"
    )
    linked = link(named, words, percent, "_body", "_id", matches, row="_row").select("_id", "_root", "_row")
    linked = stage(linked, "linked")  # so that minima are combined before they are shuffled
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")
    first = linked.groupBy("_root").agg(F.min(order)["_row"].alias("_row"))
    return rows.join(first.select("_row"), "_row", "left_semi").select(
        *(F.col(f"_doc.`{c}`") for c in docs.columns)
    )
