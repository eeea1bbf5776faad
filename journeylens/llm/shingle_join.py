"""N-gram Jaccard join: near copies among all documents by a grouped prefix join, exact for the threshold.

A document's set holds the hashes of its distinct five-word shingles (64 bits each; two different shingles of one
pair of documents meet with a chance of some |x| * |y| / 2^64). Two sets link when 100 * intersection >=
75 * union. The steps:

1. `frequent_shingles` counts shingles over all documents in bounded sketches. Shingles that are known to be
   frequent come last in the common order, so shared passages hardly ever open a posting list. Which ones
   are known changes the cost, never the result.
2. `prefixes` keeps the first |x| - ceil(0.75 |x|) + 1 shingles of each set in that order; linked sets share one.
3. Sets with the same prefix and size form one group; equal sets are one member of it. Only groups are posted.
4. `listed` sorts each posting list by size and names neighbours in it, a number of pairs linear in the list.
   `promising` drops pairs whose prefixes share too little for a link. The rest and the members of each group are
   verified on whole sets, and components are formed.
   The places of a shared token in two prefixes bound what the sets can share. Then, in rounds, each group whose list
   holds other components is held against a fixed number of groups of one of them, again a linear number. Rounds go on
   while step 5 has more pairs to try than a round, and the last one saved it as many as it tried itself.
5. What may still be missing are links between different components: pairs of groups that share a list, are promising
   and lie in different components are expanded to their members and verified too.

Step 5 sees every pair that step 4 left out, unless both are already in one component, so no component is lost, and
a large group of near copies costs a multiple of its size instead of its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .common import mix, window_hashes, word_hashes
from .components import components, relabel

WIDTH = 5
LINK_PERCENT = 75
#: Shingles that a task and the whole job remember as frequent: 16 bytes each, so at most 1 and 2 MB.
TASK_SKETCH = 1 << 16
FREQUENT = 1 << 17
#: A shingle counts as frequent from so many documents on.
FREQUENT_FROM = 8
#: A posting list is dealt to several tasks if its shingle is known to be in more documents than this.
LIST_ROWS = 10_000
#: Groups of another component that a posting is held against in a round.
TURNS = 8


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < WIDTH:
        return mix(window_hashes(hashes, len(words)) + np.uint64(len(words)))
    return np.unique(window_hashes(hashes, WIDTH))


def prefix_length(size: int) -> int:
    return size - (LINK_PERCENT * size + 99) // 100 + 1


def _may_link(n_x, at_x, n_y, at_y):
    """Whether sets of these sizes whose first common token has these places can share enough; columns or arrays."""
    slack_x = (100 + LINK_PERCENT) * (n_x - at_x) >= LINK_PERCENT * (n_x + n_y)
    return slack_x & ((100 + LINK_PERCENT) * (n_y - at_y) >= LINK_PERCENT * (n_x + n_y))


def _merge(tokens: np.ndarray, counts: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal tokens; only the `keep` largest that occur twice stay."""
    order = np.argsort(tokens, kind="stable")
    tokens, counts = tokens[order], counts[order]
    starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, np.int64)
    sums = np.add.reduceat(counts, starts) if len(starts) else counts
    tokens = tokens[starts]
    kept = np.flatnonzero(sums > 1)
    if len(kept) > keep:
        kept = kept[np.argpartition(-sums[kept], keep)[:keep]]
    return tokens[kept], sums[kept]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    waiting, held = [], 0

    def fold():
        nonlocal tokens, counts, waiting, held
        merged = np.concatenate([tokens, *waiting])
        weights = np.concatenate([counts, np.ones(held, np.int64)])
        tokens, counts = _merge(merged, weights, TASK_SKETCH)
        waiting, held = [], 0

    for batch in batches:
        for value in batch.column(0):
            new = shingles(value.as_py())
            waiting.append(new)
            held += len(new)
            if held > 1 << 21:
                fold()
    fold()
    yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts)], ["token", "seen"])


def frequent_shingles(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles found most often over all documents, sorted, and the number of bits of each count."""
    seen = documents.select("text").mapInArrow(_sketch, "token long, seen long").groupBy("token").agg(
        F.sum("seen").alias("seen")
    )
    # Bounded: at most FREQUENT rows.
    rows = seen.filter(F.col("seen") >= FREQUENT_FROM).orderBy(F.desc("seen"), "token").limit(FREQUENT).toArrow()
    tokens = rows.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.asarray(rows.column("seen").to_numpy())[order]


def _classes(tokens: np.ndarray, frequent: np.ndarray, seen: np.ndarray) -> np.ndarray | None:
    """How often each token is known to occur, None if all are rare."""
    if not len(frequent) or not len(tokens):
        return None
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    found = frequent[at] == tokens
    return np.where(found, seen[at], 0) if found.any() else None


def prefixes(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, n, set_1, set_2, prefix_1, prefix_2, last, tokens, parts) of all documents; n = 0 without words.

    set_* and prefix_* identify the set and its prefix by 128 bits; last grows with the place of the prefix's last
    token in the common order; parts has the number of tasks that each token's posting list is dealt to, null if
    it is one for each.
    """
    context = documents.sparkSession.sparkContext
    known = context.broadcast(frequent_shingles(documents))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, seen = known.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out: list[list] = [[] for _ in range(9)]
                for doc_id, value in zip(part.column(0), part.column(1)):
                    tokens = shingles(value.as_py())
                    size, keep = len(tokens), prefix_length(len(tokens)) if len(tokens) else 0
                    whole = xxhash.xxh3_128_intdigest(tokens.tobytes())
                    counts, deal, bits = _classes(tokens, frequent, seen), None, 0
                    if counts is None:
                        head = tokens[:keep]
                    else:
                        order = np.argsort(np.frexp(counts)[1], kind="stable")[:keep]
                        head, deal = tokens[order], (counts[order] // LIST_ROWS + 1).astype(np.int32)
                        bits = int(np.frexp(counts[order[-1]])[1])
                        deal = deal if deal.max() > 1 else None
                    last = bits << 57 | int(head[-1]) >> 7 if keep else 0
                    first = xxhash.xxh3_128_intdigest(head.tobytes())
                    low = (1 << 63) - 1
                    for column, item in zip(
                        out,
                        (doc_id.as_py(), size, whole & low, whole >> 65, first & low, first >> 65,
                         last, head.view(np.int64), deal),
                    ):
                        column.append(item)
                kinds = [pa.int64()] * 7 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
                arrays = [pa.array(column, kind) for column, kind in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(
                    arrays, ["doc_id", "n", "set_1", "set_2", "prefix_1", "prefix_2", "last", "tokens", "parts"]
                )

    return documents.select("doc_id", "text").mapInArrow(
        apply,
        "doc_id long, n long, set_1 long, set_2 long, prefix_1 long, prefix_2 long, last long, "
        "tokens array<long>, parts array<int>",
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by (token, part, n, gid): a row per posting in a list of its token with others,
    with its neighbour in it if the sizes allow a link."""
    rest, split = np.empty((5, 0), np.int64), None

    def emit(rows: np.ndarray) -> pa.RecordBatch:
        token, part, n, gid, at = rows
        same = (token[1:] == token[:-1]) & (part[1:] == part[:-1])
        before, after = np.r_[False, same], np.r_[same, False]
        fits = np.r_[False, same & (gid[1:] != gid[:-1]) & _may_link(n[:-1], at[:-1], n[1:], at[1:])]
        other = np.where(fits, np.r_[gid[:1], gid[:-1]], -1)
        # A list of two with a pair to verify needs no second look; those dealt to several tasks are kept whole.
        starts = np.flatnonzero(~before)
        sizes = np.diff(np.r_[starts, len(token)])
        many = np.repeat(sizes, sizes) > 2
        keep = before | after | (part >= 0)
        arrays = [token[keep], gid[keep], n[keep], at[keep], other[keep], (many | (part >= 0))[keep]]
        nulls = [None, None, None, None, arrays[4] < 0, None]
        return pa.RecordBatch.from_arrays(
            [pa.array(a, mask=m) for a, m in zip(arrays, nulls)], ["token", "gid", "n", "at", "other", "many"]
        )

    for batch in batches:
        rows = np.concatenate([rest, np.stack([np.asarray(c) for c in batch.columns]).astype(np.int64)], axis=1)
        if not rows.shape[1]:
            continue
        # Later rows of a list in pieces are pieces too, even a last one alone.
        if split is not None:
            rows[1, rows[0] == split] = np.maximum(rows[1, rows[0] == split], 0)
        last = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
        cut = int(np.argmax(last))
        if cut:
            yield emit(rows[:, :cut])
        rest = rows[:, cut:]
        # A list longer than any batch goes out in pieces; step 5 looks across them by token.
        while rest.shape[1] > 4 * LIST_ROWS:
            piece, rest = rest[:, : 2 * LIST_ROWS].copy(), rest[:, 2 * LIST_ROWS :]
            piece[1] = np.maximum(piece[1], 0)
            yield emit(piece)
            rest[1] = np.maximum(rest[1], 0)
            split = rest[0, 0]
    if rest.shape[1]:
        yield emit(rest)


def listed(heads: DataFrame) -> DataFrame:
    """Postings (token, gid, n, at, other, many) in lists of two or more; part is -1 where a list is in one task."""
    postings = heads.select("doc_id", "n", "parts", F.posexplode("tokens").alias("at", "token")).select(
        "token",
        F.when(F.get("parts", "at") > 1, F.pmod(F.xxhash64("doc_id"), F.get("parts", "at"))).otherwise(-1)
        .cast("int").alias("part"),
        F.col("n").cast("int").alias("n"),
        F.col("doc_id").alias("gid"),
        "at",
    )
    return (
        postings.repartition("token", "part")
        .sortWithinPartitions("token", "part", "n", "gid")
        .mapInArrow(_listed, "token long, gid long, n long, at long, other long, many boolean")
    )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_id, held = None, None
    for batch in batches:
        good = np.zeros(batch.num_rows, bool)
        for i, (a, text_a, text_b) in enumerate(zip(batch.column(0), batch.column(2), batch.column(3))):
            key = (a.as_py(), text_a.as_py())
            if key != held_id:
                held_id, held = key, shingles(key[1])
            other = shingles(text_b.as_py())
            shared = len(np.intersect1d(held, other, assume_unique=True))
            good[i] = shared > 0 and 100 * shared >= LINK_PERCENT * (len(held) + len(other) - shared)
        chosen = pa.array(good)
        yield pa.RecordBatch.from_arrays([c.filter(chosen) for c in batch.columns[:2]], ["a", "b"])


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose whole sets link. texts: (doc_id, text), of which only those of the pairs are moved."""
    wanted = materialize(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct())
    texts = materialize(texts.join(wanted, "doc_id", "left_semi"))
    right = texts.join(pairs.hint("shuffle_hash"), F.col("doc_id") == F.col("b")).select(
        "a", "b", F.col("text").alias("text_b")
    )
    both = right.join(texts.withColumnRenamed("text", "text_a"), F.col("a") == F.col("doc_id"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long")


def _pair(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def promising(pairs: DataFrame, posted: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of groups, those that may link, judged by their prefixes.

    posted has for each gid its size n, its last and the tokens of its prefix that others have too (null where one id
    has several texts). Tokens that two sets share up to the lesser of their lasts are in both prefixes; beyond it,
    the set it belongs to has n minus its prefix left.
    """
    a, b = (posted.select(*(F.col(c).alias(f"{c}_{x}") for c in posted.columns)) for x in "ab")
    both = pairs.join(a, F.col("a") == F.col("gid_a")).join(b, F.col("b") == F.col("gid_b"))

    def rest(x: str):
        return F.ceil(F.lit(LINK_PERCENT) * F.col(f"n_{x}") / 100) - 1

    beyond = F.when(F.col("last_a") < F.col("last_b"), rest("a")).when(F.col("last_b") < F.col("last_a"), rest("b"))
    most = F.size(F.array_intersect("tokens_a", "tokens_b")) + F.coalesce(beyond, F.greatest(rest("a"), rest("b")))
    enough = (100 + LINK_PERCENT) * most >= LINK_PERCENT * (F.col("n_a") + F.col("n_b"))
    return both.filter(F.coalesce(enough, F.lit(True))).select("a", "b")


def near_copies(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per row of documents (doc_id, text, ...).

    Null and empty texts have no shingles and are their own component. Rows that repeat an id count as one document,
    linked with what any of its texts links with; rows without an id link with nothing and have no component.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    heads = materialize(prefixes(documents))
    filled = heads.filter("n > 0 and doc_id is not null")
    whole = ["n", "set_1", "set_2", "prefix_1", "prefix_2"]
    sets = materialize(filled.groupBy(*whole).agg(F.min("doc_id").alias("rep"), F.min("last").alias("last")))
    groups = materialize(
        sets.groupBy("n", "prefix_1", "prefix_2").agg(F.min("rep").alias("gid"), F.min("last").alias("last"))
    )
    members = materialize(sets.join(groups, ["n", "prefix_1", "prefix_2"]).select("gid", F.col("rep").alias("doc_id")))
    firsts = groups.select(F.col("gid").alias("doc_id"), "n", "prefix_1", "prefix_2").hint("shuffle_hash")
    posts = filled.join(firsts, ["doc_id", "n", "prefix_1", "prefix_2"], "left_semi").select("doc_id", "n", "tokens", "parts")
    lists = materialize(listed(posts))
    one = F.count(F.lit(1)) == 1
    sizes = groups.groupBy("gid").agg(F.when(one, F.max("n")).alias("n"), F.when(one, F.max("last")).alias("last"))
    posted = materialize(lists.groupBy("gid").agg(F.collect_set("token").alias("tokens")).join(sizes, "gid"))

    # Linear candidates: neighbours in a list, members with the first of their group.
    neighbours = materialize(lists.filter("other is not null").select(*_pair("gid", "other")).distinct())
    inside = members.filter("gid <> doc_id").select(*_pair("gid", "doc_id"))
    candidates = materialize(promising(neighbours, posted).unionByName(inside).distinct())
    links = materialize(verify(candidates, documents))

    # Rows of one id with several texts are one document.
    owners = filled.join(sets.drop("last"), whole).select("doc_id", "rep")
    several = owners.groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least <> most")
    pooled = materialize(
        owners.join(several.select("doc_id", "least"), "doc_id").select(*_pair("least", "rep")).filter("a <> b").distinct()
    )

    links = links.unionByName(pooled)
    labels = materialize(components(links))
    done = neighbours.unionByName(candidates)
    # Components only grow together, so a list that lies in one does so in all later rounds.
    opened = _open_lists(lists.filter("many").select("token", "gid", "n", "at"), members, labels)
    turn, (tried, left) = 0, _pairs(opened)
    while left > tried:
        drawn, waiting = _between(opened[2], posted, members, labels, turn, opened)
        more = materialize(drawn.join(done, ["a", "b"], "left_anti"))
        found = materialize(verify(more, documents))
        done = done.unionByName(more)
        if not found.limit(1).count():
            break
        labels = materialize(relabel(labels, found))
        opened = _open_lists(waiting, members, labels)
        turn, before, spent = turn + TURNS, left, tried
        tried, left = _pairs(opened)
        if before - left < spent:
            break
    more = materialize(_across(lists, opened, posted).join(done, ["a", "b"], "left_anti"))
    found = materialize(verify(more, documents))
    if found.limit(1).count():
        labels = materialize(relabel(labels, found))

    classes = materialize(
        sets.join(labels, F.col("rep") == F.col("node"), "left").select(*whole, F.coalesce("component", "rep").alias("class"))
    )
    return heads.select("doc_id", *whole).join(classes, whole, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("component_id"),
    )


def _open_lists(
    waiting: DataFrame, members: DataFrame, labels: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Members with their components; the least and largest of each group; postings of lists with several of them;
    the number of postings of these lists and of their pairs in different components."""
    labelled = materialize(
        members.join(labels, F.col("doc_id") == F.col("node"), "left").select(
            "gid", "doc_id", F.coalesce("component", "doc_id").alias("component")
        )
    )
    spread = materialize(
        labelled.groupBy("gid").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), (F.count(F.lit(1)) > 1).alias("several")
        )
    )
    listing = materialize(waiting.join(spread, "gid"))
    held = listing.groupBy("token", "low").agg(F.max("high").alias("high"), F.count(F.lit(1)).cast("double").alias("n"))
    split = materialize(
        held.groupBy("token")
        .agg(
            F.min("low").alias("l"),
            F.max("high").alias("h"),
            F.sum("n").alias("postings"),
            ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"),
        )
        .filter("l <> h")
        .select("token", "postings", "pairs")
    )
    return labelled, spread, materialize(listing.join(split.select("token"), "token")), split


def _pairs(opened: tuple[DataFrame, ...]) -> tuple[float, float]:
    """The pairs that a round may try in the open lists, and those that step 5 has to, which grow with their squares."""
    none = F.lit(0.0)
    postings, pairs = opened[3].agg(F.coalesce(F.sum("postings"), none), F.coalesce(F.sum("pairs"), none)).first()
    return TURNS * postings, pairs


def _between(
    waiting: DataFrame, posted: DataFrame, members: DataFrame, labels: DataFrame, first: int,
    opened: tuple[DataFrame, ...] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """For each posting of a list with several components, up to TURNS pairs (a, b) with groups of another one.

    Rounds that start with another `first` turn draw other groups. Also the postings of these lists, of which alone
    later rounds may still have some. `opened` is what `_open_lists` found, where it is known.
    """
    rows = (opened or _open_lists(waiting, members, labels))[2]
    turns = [
        F.struct("low", F.xxhash64("token", "gid", F.lit(first + i)).alias("turn"), "gid", "n", "at") for i in range(TURNS)
    ]
    lows, highs = F.array(*(F.min(t) for t in turns)), F.array(*(F.max(t) for t in turns))
    ends = materialize(rows.groupBy("token").agg(lows.alias("x"), highs.alias("y")))
    others = F.when(F.col("low") == F.col("x")[0]["low"], F.col("y")).otherwise(F.col("x"))

    def may_link(other: Column) -> Column:
        return _may_link(F.col("n"), F.col("at"), other["n"], other["at"]) & (F.col("gid") != other["gid"])

    # Judged before rows are made of them; in a short list several turns draw the same group.
    drawn = F.array_distinct(F.transform(F.filter(others, may_link), lambda other: other["gid"]))
    fits = rows.join(ends, "token").select("gid", F.explode(drawn).alias("other")).select(*_pair("gid", "other")).distinct()
    return promising(fits, posted), rows.select("token", "gid", "n", "at")


def _across(lists: DataFrame, opened: tuple[DataFrame, ...], posted: DataFrame) -> DataFrame:
    """Pairs (a, b) of members in different components whose groups are one or share a list and are promising.

    A pair of groups that was found wanting before is wanting for all of their members.
    """
    labelled, spread, rows, _ = opened
    left, right = rows.alias("l"), rows.alias("r")
    fits = (F.col("l.token") == F.col("r.token")) & (F.col("l.gid") < F.col("r.gid"))
    sizes = _may_link(F.col("l.n"), F.col("l.at"), F.col("r.n"), F.col("r.at"))
    apart = (F.col("l.low") != F.col("r.low")) | (F.col("l.high") != F.col("r.high")) | (F.col("l.low") != F.col("l.high"))
    shared = left.join(right, fits & sizes & apart).select(F.col("l.gid").alias("a"), F.col("r.gid").alias("b"))
    # Neighbours in a list have been held against each other, but not all members of their groups.
    grown = spread.filter("several").select("gid")
    near = lists.filter("other is not null").select("gid", "other")
    near = near.join(grown, "gid", "left_semi").unionByName(
        near.join(grown.withColumnRenamed("gid", "other"), "other", "left_semi").select("gid", "other")
    )
    pairs = promising(near.select(*_pair("gid", "other")).unionByName(shared).distinct(), posted).unionByName(
        spread.filter("low <> high").select(F.col("gid").alias("a"), F.col("gid").alias("b"))
    )
    x = labelled.select(F.col("gid").alias("a"), F.col("doc_id").alias("x"), F.col("component").alias("cx"))
    y = labelled.select(F.col("gid").alias("b"), F.col("doc_id").alias("y"), F.col("component").alias("cy"))
    return pairs.join(x, "a").join(y, "b").filter("cx <> cy").select(*_pair("x", "y")).distinct()
