"""Similarity and text joins: exact, without cross joins and without unbounded groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgate.functions import columns as c
from corpusgate.operators import ordering
from corpusgate.session import durable

# --- near duplicates --------------------------------------------------------------------------

#: Rows of ids that may be broadcast, counted first; beyond it Spark shuffles both sides.
BROADCAST_IDS = 1_000_000
#: Bits of the slot of a token hash: a fixed table of that many slots says how frequent a slot's tokens are.
SLOT_BITS = 22
#: Words of 64 parity bits of a set; members of a family that meet in one cell; sets that one verifying group holds.
PARITY_WORDS, FAMILY_CELL, GROUP_SETS = 16, 256, 2_000


def token_classes(
    rows: DataFrame,
    row_id: str,
    block: Sequence[str],
    text: str,
    tokens: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(classes, members)``: rows with equal block and token set form one class.

    A class is named by its smallest row id, so a group of exact copies costs one row from here on
    however large it is. ``members`` maps every row with a non-empty token set to its class.
    """
    toks = F.sort_array(F.array_distinct(c.word_tokens(text) if tokens is None else tokens))
    sets = rows.select(F.col(row_id).alias("row_id"), *block, toks.alias("tokens")).where(
        F.size("tokens") > 0
    )
    key = F.concat_ws("\u0001", F.to_json(F.struct(F.lit(0), *block)), F.array_join("tokens", " "))
    sets = durable(sets.withColumn("digest", F.sha2(key, 256)), "token-sets", "zstd")
    reps = (
        sets.groupBy("digest")
        .agg(F.min("row_id").alias("class_id"), F.count(F.lit(1)).alias("n"))
        .withColumnRenamed("digest", "__digest")
    )
    members = sets.select("row_id", "digest").join(reps, F.col("digest") == F.col("__digest"))
    members = members.select("row_id", "class_id")
    # Eight bytes of the digest tell apart the texts of one id.
    heads = reps.where(F.col("class_id").isNotNull()).select(F.col("class_id").alias("row_id"), F.xxhash64("__digest").alias("__d"), "n")
    heads = durable(heads, "heads")
    few = heads.count() <= BROADCAST_IDS
    classes = sets.withColumn("__d", F.xxhash64("digest")).join(F.broadcast(heads) if few else heads, ["row_id", "__d"])
    classes = classes.drop("digest", "__d").withColumnRenamed("row_id", "class_id")
    return (classes if few else durable(classes, "classes", "zstd")), members


def _levels(classes: DataFrame) -> bytes:
    """How frequent the tokens of each slot of hashes are: a byte a slot, 0 where each has one holder.

    Counts are exact and pre-aggregated. The table has a fixed size, however many tokens there are, and
    only decides their order.
    """
    tokens = classes.select(F.explode("tokens").alias("tok")).select(F.xxhash64("tok").alias("tok"))
    counts = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    slots = counts.groupBy(F.shiftrightunsigned("tok", 64 - SLOT_BITS).cast("int").alias("slot")).agg(
        F.floor(F.log2(F.max("f")) * 4).cast("short").alias("level")
    )
    found = slots.toArrow()
    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    levels[found["slot"].to_numpy()] = np.minimum(found["level"].to_numpy(), 255)
    return levels.tobytes()


def _ordered(classes: DataFrame, keep: Sequence[Column] = (), share: float | None = None) -> DataFrame:
    """``(class_id, keep.., size, ordered, parity)``: token hashes of each class from rare to common, cut in place.

    Of a set of ``n`` the first ``n - ceil(share * n) + 1`` are kept, all without ``share``. ``parity`` has
    a bit for each remainder of hashes by ``64 * PARITY_WORDS``: whether the set has an odd number of them.
    Nothing is shuffled but the counts behind the order.
    """
    levels = classes.sparkSession.sparkContext.broadcast(_levels(classes))
    bits, words = SLOT_BITS, PARITY_WORDS
    hashed = classes.select("class_id", *keep, F.transform("tokens", lambda x: F.xxhash64(x)).alias("hashes"))
    kept = hashed.columns[:-1]
    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in hashed.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(levels.value, np.uint8)
        for batch in batches:
            lists = batch.column("hashes")
            key = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(n)])
            own = np.repeat(np.arange(len(n)), n)
            by = np.lexsort((key, table[key >> np.uint64(64 - bits)], own))
            most = n if share is None else np.minimum(n, n - np.ceil(share * n - 1e-9).astype(np.int64) + 1)
            first = by[np.arange(len(key)) - starts[own] < most[own]]
            bit = own * (words * 64) + (key % np.uint64(words * 64)).astype(np.int64)
            odd = (np.bincount(bit, minlength=len(n) * words * 64) & 1).astype(np.uint8)
            parity = np.packbits(odd, bitorder="little").view(np.int64)
            cut = np.concatenate([[0], np.cumsum(most)])
            columns = [batch.column(x) for x in kept] + [
                pa.array(n.astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(key[first].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * words, pa.int32()), pa.array(parity)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "size", "ordered", "parity"])

    return hashed.mapInArrow(run, f"{schema}, size int, ordered array<bigint>, parity array<bigint>")


def rare_first(classes: DataFrame) -> DataFrame:
    """``(class_id, ordered)``: the token hashes of each class from rare to common, by exact counts.

    The counts meet the sets as a table of fixed size, so no posting is shuffled. Tokens that share a slot
    of it with a more frequent one come as late as that one; the order is the same for all classes.
    """
    return _ordered(classes).select("class_id", "ordered")


def near_duplicate_classes(
    classes: DataFrame, block: Sequence[str], threshold: float = 0.75, cell: int = 2_000
) -> DataFrame:
    """Class pairs with Jaccard >= ``threshold`` in a block, plus one row per class of copies.

    Exact. Tokens are put in one rare-first order; two sets can only reach the threshold if they share one
    of their first ``n - ceil(t*n) + 1`` tokens, and the first token they share leaves room for enough shared
    ones behind it in both. Only pairs with such a token are kept; for that the smaller set needs no more
    than its first ``n - ceil(2t/(1+t)*n) + 1`` tokens. The holders of a popular token are dealt into cells
    of about ``cell`` classes, and each two cells meet under a key of their own, so no key compares more
    than ``cell`` * ``cell`` pairs. Parity bits of both sets then bound how many tokens they do not share,
    which leaves few pairs to verify on whole sets: up to ``BROADCAST_IDS`` sets the bits are broadcast, so no
    other pair is shuffled. ``n_pairs`` is the number of row pairs a class pair stands for.
    """
    t = F.lit(float(threshold))
    block_key = F.xxhash64(*block) if block else F.lit(0).cast("long")
    # Tells classes apart, also where two texts share an id.
    keyed = classes.withColumn("__key", F.xxhash64("class_id", block_key, "tokens"))
    ranked = _ordered(keyed, [F.col("__key"), block_key.alias("blk")], threshold).drop("class_id")
    words = [F.col("parity")[i].alias(f"v{i}") for i in range(PARITY_WORDS)]
    ranked = ranked.select(F.monotonically_increasing_id().alias("class_id"), "__key", "blk", "size", "ordered", *words)
    ranked = durable(ranked, "prefixes", "zstd")
    # A token's hash takes in its block; equal hashes of different ones cost a comparison, never a result.
    exploded = ranked.select("class_id", "blk", "size", F.posexplode("ordered").alias("at", "tok"))
    postings = exploded.select("class_id", F.lit(0).cast("long").alias("blk"), "size", "at", F.xxhash64("blk", "tok").alias("tok"))
    left, right = _triangle(postings, cell)
    # The small slack keeps a bound from rounding up past an exact one.
    need = lambda total: F.ceil(t / (F.lit(1.0) + t) * total - F.lit(1e-9))
    na, nb = F.col("na"), F.col("nb")
    # In one cell the smaller set stands on the left; cells of a popular token meet once, whichever set is smaller.
    apart_cells = F.col("low") < F.col("high")
    once = apart_cells | (na < nb) | ((na == nb) & (F.col("a") < F.col("b")))
    room = F.least(na - F.col("pa"), nb - F.col("pb")) >= need(na + nb)
    met = (
        left.where(apart_cells | (na - F.col("pa") >= need(na + na)))
        .join(right.hint("merge"), ["blk", "tok", "low", "high"])  # postings are more rows than their files' size tells
        .where(once & (F.least(na, nb) >= t * F.greatest(na, nb) - F.lit(1e-9)) & room)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (na + nb).alias("total"))
    )
    few = ranked.count() <= BROADCAST_IDS
    if not few:
        met = met.distinct()
    bits = [ranked.select(F.col("class_id").alias(x), *[F.col(f"v{i}").alias(f"{x}{i}") for i in range(PARITY_WORDS)]) for x in ("a", "b")]
    for x, side in zip(("a", "b"), bits):
        met = met.join(F.broadcast(side) if few else side, x)
    apart = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(PARITY_WORDS)), F.lit(0))
    candidates = durable(met.where(F.col("total") - apart >= 2 * need(F.col("total"))).select("a", "b").distinct(), "candidates")
    similar = _verified(candidates, ranked.select("class_id", "__key"), keyed, threshold)
    ends = [
        keyed.select(F.col("__key").alias(f"__k{x}"), F.struct(F.col("class_id").alias("id"), "n", *block).alias(x))
        for x in ("a", "b")
    ]
    joined = similar.join(ends[0], "__ka").join(ends[1], "__kb")
    same_block = F.lit(True)
    for x in block:
        same_block = same_block & F.col(f"a.{x}").eqNullSafe(F.col(f"b.{x}"))
    flip = F.col("b.id") < F.col("a.id")
    first = lambda f: F.when(flip, F.col(f"b.{f}")).otherwise(F.col(f"a.{f}"))
    other = lambda f: F.when(flip, F.col(f"a.{f}")).otherwise(F.col(f"b.{f}"))
    pairs = joined.where(same_block & (F.col("a.id") != F.col("b.id"))).select(
        first("id").alias("a"), other("id").alias("b"), *[F.col(f"a.{x}").alias(x) for x in block], "similarity",
        first("n").alias("n_a"), other("n").alias("n_b"), (F.col("a.n") * F.col("b.n")).alias("n_pairs"),
    )
    copies = classes.where("n > 1").select(
        F.col("class_id").alias("a"),
        F.col("class_id").alias("b"),
        *block,
        F.lit(1.0).alias("similarity"),
        F.col("n").alias("n_a"),
        F.col("n").alias("n_b"),
        (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("n_pairs"),
    )
    return pairs.unionByName(copies)


def _verified(candidates: DataFrame, numbered: DataFrame, keyed: DataFrame, threshold: float) -> DataFrame:
    """``(__ka, __kb, similarity)`` of the candidate pairs that reach the threshold on their whole sets.

    Both classes of a pair go to the smallest neighbour of either, so a family of near copies meets once and
    a set is shipped once a family, not once a pair. Members of a large family are dealt into cells of about
    ``FAMILY_CELL``, and each two cells meet apart. Sets are compared as 64-bit hashes of their tokens.
    """
    both = candidates.union(candidates.select("b", "a"))
    home = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("home")).withColumnRenamed("a", "class_id")
    home = durable(home, "homes")
    few = home.count() <= BROADCAST_IDS
    small = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    at = [home.select(F.col("class_id").alias(x), F.col("home").alias(f"h{x}")) for x in ("a", "b")]
    housed = candidates.join(small(at[0]), "a").join(small(at[1]), "b").select("a", "b", F.least("ha", "hb").alias("home"))
    sizes = home.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / F.lit(FAMILY_CELL)).cast("int").alias("cells")).where("cells > 1")
    housed = housed.join(sizes, "home", "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    dealt = [F.pmod(F.xxhash64(x), F.col("cells")).cast("int") for x in ("a", "b")]
    meeting = F.xxhash64("home", F.least(*dealt), F.greatest(*dealt))
    housed = durable(housed.select("a", "b", meeting.alias("meeting")), "meetings")
    roles = housed.select("meeting", F.col("a").alias("class_id")).union(housed.select("meeting", "b")).distinct()
    roles = durable(roles, "roles")
    groups = roles.count() // GROUP_SETS + 1
    group = F.pmod("meeting", F.lit(groups)).cast("int").alias("group")
    shipped = roles.select(group, "class_id").distinct()
    wanted = home.select("class_id").join(numbered, "class_id")
    sets = keyed.drop("class_id").join(small(wanted), "__key")
    sets = sets.select("class_id", "__key", F.sort_array(F.transform("tokens", lambda x: F.xxhash64(x))).alias("hashes"))
    shipped = sets.join(shipped, "class_id").select("group", "class_id", "__key", "hashes")

    def compare(pairs: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        where = dict(zip(held["class_id"], range(len(held))))
        hashes, keys = held["hashes"].to_numpy(), held["__key"].to_numpy()
        a = np.fromiter(map(where.__getitem__, pairs["a"]), np.int64, len(pairs))
        b = np.fromiter(map(where.__getitem__, pairs["b"]), np.int64, len(pairs))
        score = np.zeros(len(pairs))
        for i, (x, y) in enumerate(zip(hashes[a], hashes[b])):
            place = np.searchsorted(x, y)
            shared = np.count_nonzero(x[np.minimum(place, len(x) - 1)] == y)
            score[i] = shared / (len(x) + len(y) - shared)
        good = score >= threshold
        return pd.DataFrame({"__ka": keys[a[good]], "__kb": keys[b[good]], "similarity": score[good]})

    pairs = housed.select(group, "a", "b")
    found = pairs.groupBy("group").cogroup(shipped.groupBy("group")).applyInPandas(compare, "__ka long, __kb long, similarity double")
    # A class that stands in several rows of ``keyed`` was numbered as often.
    return found.select(F.least("__ka", "__kb").alias("__ka"), F.greatest("__ka", "__kb").alias("__kb"), "similarity").distinct()


def _triangle(postings: DataFrame, cell: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join of ``postings`` with itself, keyed by ``(blk, tok, low, high)``.

    A holder in cell ``c`` of ``n`` stands on the left of the cell pairs ``(c, c..n-1)`` and on the
    right of ``(0..c, c)``, so each two holders of a token meet once. Tokens of more than one cell are at
    most one in ``cell`` of the postings, so they are broadcast; others stay whole.
    """
    hot = (
        postings.groupBy("blk", "tok")
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(cell)).cast("int").alias("cells"))
        .where("cells > 1")
    )
    dealt = postings.join(F.broadcast(hot), ["blk", "tok"], "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("cells")).cast("int"))
    left = dealt.select(
        "blk", "tok", F.col("own").alias("low"), F.explode(F.sequence("own", F.col("cells") - 1)).alias("high"),
        F.col("class_id").alias("a"), F.col("size").alias("na"), F.col("at").alias("pa"),
    )
    right = dealt.select(
        "blk", "tok", F.explode(F.sequence(F.lit(0), "own")).alias("low"), F.col("own").alias("high"),
        F.col("class_id").alias("b"), F.col("size").alias("nb"), F.col("at").alias("pb"),
    )
    return left, right


def near_duplicates(
    rows: DataFrame, row_id: str, block: Sequence[str], text: str, threshold: float = 0.75, **kwargs
) -> DataFrame:
    """Near-duplicate class pairs of a table; see :func:`near_duplicate_classes`."""
    classes, _ = token_classes(rows, row_id, block, text)
    return near_duplicate_classes(classes, block, threshold, **kwargs)


def claim_signature(claims: DataFrame) -> DataFrame:
    """Block key of the near-duplicate policy: paper, type, sorted symbol and assumption links."""
    def packed(col: str) -> Column:
        return F.array_join(F.sort_array(F.coalesce(F.col(col), F.array().cast("array<string>"))), "\u0001")

    return claims.withColumn(
        "signature",
        F.concat_ws(
            "\u0002", F.coalesce("claim_type", F.lit("")), packed("linked_symbols"), packed("linked_assumptions")
        ),
    )


def unreused_near_duplicates(
    claims: DataFrame,
    row_id: str = "id",
    block: Sequence[str] = ("paper_id", "signature"),
    text: str = "informal_text",
    kind: str = "value_kind",
    threshold: float = 0.75,
    reuse_kinds: Sequence[str] = c.REUSE_VALUE_KINDS,
) -> DataFrame:
    """Rows in a near-duplicate pair where both kinds are stated and neither is a reuse kind.

    One row per offending claim with the number of its offending partners and the smallest partner
    id. Counting per class keeps a group of N copies at N rows instead of N*N pairs.
    """
    enforceable = claims.where(
        F.coalesce(F.col(kind) != "", F.lit(False)) & ~F.col(kind).isin(*reuse_kinds)
    )
    classes, members = token_classes(enforceable, row_id, block, text)
    pairs = near_duplicate_classes(classes, block, threshold).where("a != b")
    partners = pairs.select(F.col("a").alias("class_id"), F.col("b").alias("other"), "n_b").unionByName(
        pairs.select(F.col("b").alias("class_id"), F.col("a").alias("other"), F.col("n_a").alias("n_b"))
    )
    outside = partners.groupBy("class_id").agg(
        F.sum("n_b").alias("__n"), F.min("other").alias("__min")
    )
    # A class is named by its smallest member; the second smallest is that member's partner.
    inside = members.groupBy("class_id").agg(
        F.count(F.lit(1)).alias("__size"),
        F.min(F.when(F.col("row_id") != F.col("class_id"), F.col("row_id"))).alias("__m2"),
    )
    joined = members.join(inside, "class_id").join(outside, "class_id", "left")
    n = F.col("__size") - 1 + F.coalesce("__n", F.lit(0))
    inner = F.when(F.col("row_id") == F.col("class_id"), F.col("__m2")).otherwise(F.col("class_id"))
    return joined.withColumn("partners", n).where("partners > 0").select(
        F.col("row_id").alias(row_id), "partners", F.least(inner, F.col("__min")).alias("first_partner")
    )


# --- overlap suggestions ----------------------------------------------------------------------


def suggest_by_overlap(
    items: DataFrame,
    item_id: str,
    item_text: str,
    candidates: DataFrame,
    candidate_id: str,
    candidate_text: str,
    candidate_pos: str,
    group: Sequence[str] = (),
    k: int = 5,
    cell_tokens: int = 400_000,
) -> DataFrame:
    """Best ``k`` candidates of the same group per item by Jaccard of ``[a-z0-9]+`` tokens, score > 0.

    Ties keep candidate order. Items and candidates of a group meet in cells of about ``cell_tokens``
    tokens a side; each returns at most ``k`` rows per item, so no pair list is ever shuffled. The plan
    is the same at every size, and nothing runs while it is built.
    """
    left = items.select(*group, F.col(item_id).alias("item"), F.array_distinct(c.alnum_tokens(item_text)).alias("tokens"))
    # Fresh names keep the two sides apart when both come from one table.
    right = candidates.select(
        *[F.col(g).alias(g) for g in group],
        F.col(candidate_id).alias("cand"),
        F.col(candidate_pos).cast("long").alias("pos"),
        F.array_distinct(c.alnum_tokens(candidate_text)).alias("tokens"),
    )
    left = left.where(F.size("tokens") > 0)
    right = right.where(F.size("tokens") > 0)
    types = dict(left.dtypes) | dict(right.dtypes)
    names = [*group, "item", "cand"]
    schema = ", ".join(f"{x} {types[x]}" for x in names) + ", pos long, score double"
    scored = _score_cells(left, right, k, list(group), schema, cell_tokens)
    best = ordering.top_k(scored, [*group, "item"], [F.col("score").desc(), F.col("pos")], k)
    return best.select(
        *group, F.col("item").alias(item_id), "rank", F.col("cand").alias(candidate_id), "score"
    )


def _score_cells(
    left: DataFrame, right: DataFrame, k: int, group: list[str], schema: str, cell_tokens: int
) -> DataFrame:
    cells = F.greatest(F.ceil(F.sum(F.size("tokens")) / F.lit(cell_tokens)), F.lit(1)).cast("int")
    n_left, n_right = cells.alias("n_left"), cells.alias("n_right")

    def sized(df: DataFrame) -> DataFrame:
        if not group:
            return df.withColumn("n_left", left.agg(n_left).scalar()).withColumn(
                "n_right", right.agg(n_right).scalar()
            )
        both = left.groupBy(*group).agg(n_left).join(right.groupBy(*group).agg(n_right), list(group))
        return df.join(both, list(group))

    def spread(df: DataFrame, key: str, mine: str, theirs: str, my_cell: str, their_cell: str) -> DataFrame:
        return sized(df).select(
            *[F.col(x).alias(x) for x in df.columns],
            F.pmod(F.xxhash64(key), F.col(mine)).cast("int").alias(my_cell),
            F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)).alias(their_cell),
        )

    lcells = spread(left, "item", "n_left", "n_right", "lc", "rc")
    rcells = spread(right, "cand", "n_right", "n_left", "rc", "lc")
    keys = [*group, "lc", "rc"]

    def score(items: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        return _score_items(items, _cell_index(cands), k, group)

    return lcells.groupBy(*keys).cogroup(rcells.groupBy(*keys)).applyInPandas(score, schema=schema)


def _cell_index(cands: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, dict[str, np.ndarray]]:
    """Candidates in list order, their set sizes and the rows that hold each token."""
    cands = cands.sort_values("pos", kind="stable").reset_index(drop=True)
    sizes = np.array([len(t) for t in cands["tokens"]])
    index: dict[str, list[int]] = {}
    for row, toks in enumerate(cands["tokens"]):
        for tok in toks:
            index.setdefault(tok, []).append(row)
    return cands[["cand", "pos"]], sizes, {tok: np.array(rows) for tok, rows in index.items()}


def _score_items(items: pd.DataFrame, index: tuple, k: int, group: list[str]) -> pd.DataFrame:
    """Top ``k`` indexed candidates for each item."""
    cands, sizes, postings = index
    ids, picks, scores = [], [], []
    for item, toks in zip(items["item"], items["tokens"]):
        hits = [postings[t] for t in toks if t in postings]
        if not hits:
            continue
        shared = np.bincount(np.concatenate(hits), minlength=len(cands))
        score = shared / (len(toks) + sizes - shared)
        order = np.argsort(-score, kind="stable")[:k]
        order = order[score[order] > 0]
        ids.extend([item] * len(order))
        picks.extend(order.tolist())
        scores.extend(score[order].tolist())
    chosen = cands.iloc[picks]
    out = {x: [items[x].iloc[0]] * len(ids) for x in group}
    out |= {"item": ids, "cand": chosen["cand"].to_numpy(), "pos": chosen["pos"].to_numpy(), "score": scores}
    return pd.DataFrame(out)


# --- substring joins --------------------------------------------------------------------------


def contains_join(
    texts: DataFrame,
    text: str,
    needles: DataFrame,
    needle: str,
    ignore_case: bool = False,
) -> DataFrame:
    """Rows of ``texts`` beside every ``needles`` row whose string occurs in the text.

    Exact and equi-joined: each needle is represented by one anchor that any text containing it must
    also contain. A word enclosed by other characters inside the needle is an anchor, the rarest by its
    count in all texts; needles without one use a three-character (or shorter) piece. Only hashes of
    texts and needles travel with the anchors; whole texts are joined once, to the candidates left.
    Needles and their anchors are stored, so that their true size is known: where they are few, the words
    and pieces of the texts meet them in place and only hits are shuffled.
    Equal hashes of different texts cost a comparison, never a result.
    """
    fold = (lambda x: F.lower(x)) if ignore_case else (lambda x: x)
    keyed_texts = texts.withColumn("__hk", F.xxhash64(fold(F.col(text))))
    hay = keyed_texts.select("__hk", fold(F.col(text)).alias("__hay"))
    named = needles.withColumn("__needle", fold(F.col(needle))).where(F.length("__needle") > 0)
    named = durable(named.withColumn("__nk", F.xxhash64("__needle")), "needles")
    inner_words = F.regexp_extract_all(
        "__needle", F.lit(r"(?<=[^A-Za-z0-9])[A-Za-z0-9]+(?=[^A-Za-z0-9])"), F.lit(0)
    )
    keyed = named.select("__nk", "__needle", F.array_distinct(inner_words).alias("__words"))
    words = hay.select("__hk", F.explode(F.array_distinct(F.regexp_extract_all("__hay", F.lit("[A-Za-z0-9]+"), F.lit(0)))).alias("__anchor"))
    wanted = keyed.select("__nk", F.explode("__words").alias("__anchor")).distinct()
    counts = words.join(wanted.select("__anchor").distinct(), "__anchor", "left_semi").groupBy("__anchor").agg(F.count(F.lit(1)).alias("f"))
    # A word of a needle that no text holds comes first: such a needle occurs nowhere.
    place = F.struct(F.coalesce("f", F.lit(0)).alias("f"), (-F.length("__anchor")).alias("l"), F.col("__anchor").alias("w"))
    by_word = durable(wanted.join(counts, "__anchor", "left").groupBy("__nk").agg(F.min(place)["w"].alias("__anchor")), "anchors")
    word_hits = words.join(by_word, "__anchor").select("__hk", "__nk")

    sized = keyed.where(F.size("__words") == 0).withColumn("__width", F.least(F.length("__needle"), F.lit(3)))
    sized = durable(
        sized.select("__nk", "__width", F.col("__needle").substr(F.lit(1), F.col("__width")).alias("__anchor")).distinct(), "anchors"
    )
    widths = sized.agg(F.collect_set("__width")).scalar()  # some of 1, 2 and 3
    piece_texts = hay.select("__hk", "__hay", F.explode(widths).alias("__width"))
    # Characters are split once, so building the pieces is linear in the text.
    char = lambda i: F.coalesce(F.get(F.col("__chars"), i), F.lit(""))
    pieces = F.transform(
        "__chars",
        lambda ch, i: F.concat(
            ch,
            F.when(F.col("__width") >= 2, char(i + 1)).otherwise(""),
            F.when(F.col("__width") >= 3, char(i + 2)).otherwise(""),
        ),
    )
    piece_hits = (
        piece_texts.withColumn("__chars", F.split("__hay", ""))
        .select("__hk", "__width", F.explode(F.array_distinct(pieces)).alias("__anchor"))
        .join(sized, ["__width", "__anchor"])
        .select("__hk", "__nk")
    )
    candidates = word_hits.unionByName(piece_hits).distinct()
    both = keyed_texts.join(candidates, "__hk").join(named, "__nk")
    return both.where(F.contains(fold(F.col(text)), F.col("__needle"))).drop("__hk", "__nk", "__needle")


def search_rows(rows: DataFrame, fields: Sequence[str], queries: DataFrame, query: str) -> DataFrame:
    """Case-insensitive substring search of many queries over several fields; blank queries find nothing.

    Returns the row beside each query that occurs in any of the fields.
    """
    wanted = queries.where(c.not_blank(query)).withColumn("__query", c.strip(query))
    texts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    joined = rows.withColumn("__all", F.concat_ws("\u0001", *texts))
    hits = contains_join(joined, "__all", wanted, "__query", ignore_case=True)
    in_field = F.lit(False)
    for t in texts:
        in_field = in_field | F.contains(F.lower(t), F.lower("__query"))
    return hits.where(in_field).drop("__all", "__query")


def search_index(rows: DataFrame, row_id: str, group: str, text: str, width: int = 200) -> DataFrame:
    """``(id, group, snippet)`` with the text cut to the width the search sees."""
    return rows.select(row_id, group, F.substring(F.col(text), 1, width).alias("snippet"))


def first_match(names: DataFrame, name: str, texts: DataFrame, text: str, pos: str, value: Column) -> DataFrame:
    """Per name the value of the first text (by position) that contains it and yields a value."""
    hits = contains_join(texts, text, names.select(name).distinct(), name, ignore_case=True)
    useful = hits.withColumn("value", value).where(F.col("value").isNotNull())
    return useful.groupBy(name).agg(F.min_by("value", pos).alias("value"), F.min(pos).alias(pos))


# --- name and path joins ----------------------------------------------------------------------


def mention_join(
    docs: DataFrame,
    doc_id: str,
    body: str,
    names: DataFrame,
    name: str,
    self_name: str | None = None,
    token: str = "[A-Za-z0-9_']+",
) -> DataFrame:
    """Known names that occur as whole identifiers in each body, minus the row's own name."""
    keep = [doc_id] + ([self_name] if self_name else [])
    found = docs.select(
        *keep, F.explode(F.array_distinct(F.regexp_extract_all(body, F.lit(token), F.lit(0)))).alias(name)
    )
    hits = found.join(names, name)
    if self_name and self_name != name:
        hits = hits.where(~F.col(name).eqNullSafe(F.col(self_name)))
    return hits


def prefix_join(
    tokens: DataFrame,
    token: str,
    names: DataFrame,
    name: str,
    pos: str,
    self_name: str | None = None,
    group: Sequence[str] = (),
) -> DataFrame:
    """Shortest name of the group that starts with the token (first in list order on ties), never the row's own.

    Names are listed under their prefixes of the lengths that tokens have, and each prefix keeps its two
    best names, limited in the map tasks already, so the match is an equi-join on group and prefix. It is
    asked to merge, as the prefixes are more rows than the size of the names tells.
    """
    lengths = tokens.agg(F.collect_set(F.length(token))).scalar()  # as many numbers as token lengths
    listed = (
        names.groupBy(*group, name).agg(F.min(pos).alias("__pos"))
        .withColumn("__len", F.length(name))
        .where("__len > 0")
        .withColumn("__at", F.explode(F.array_intersect(F.sequence(F.lit(1), F.col("__len")), lengths)))
        .withColumn("__prefix", F.substring(F.col(name), F.lit(1), F.col("__at")))
    )
    keys = [*group, "__prefix"]
    two = ordering.top_k(listed, keys, [F.col("__len"), F.col("__pos"), F.col(name)], 2, "__rank")
    nth = lambda k: F.max(F.when(F.col("__rank") == k, F.col(name)))
    choice = two.groupBy(*keys).agg(nth(1).alias("__b1"), nth(2).alias("__b2"))
    hits = tokens.withColumn("__prefix", F.col(token)).join(choice.hint("merge"), keys)
    match = F.col("__b1")
    if self_name:
        hits = hits.where(~F.col(token).eqNullSafe(F.col(self_name)))
        match = F.when(match.eqNullSafe(F.col(self_name)), F.col("__b2")).otherwise(match)
    return hits.withColumn("match", match).where(F.col("match").isNotNull()).drop("__prefix", "__b1", "__b2")


def path_prefix_join(
    files: DataFrame,
    path: str,
    prefixes: DataFrame,
    prefix: str,
    owner: str,
    pos: str,
    extension: str = "",
    text: str | None = None,
    declared: str = r"namespace\s+([A-Za-z0-9_.]+)",
) -> DataFrame:
    """Owner of each file: the first prefix equal to the file or one of its folders.

    Files without one fall back to the first namespace declared in ``text`` that is a known prefix
    (prefix paths are dotted names there). Files keep one row each; unowned files get null.
    """
    parts = F.split(F.replace(F.col(path), F.lit("\\"), F.lit("/")), "/")
    folders = F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")
    )
    folders = F.when(F.size(parts) > 1, folders).otherwise(F.array().cast("array<string>"))
    whole = F.array_join(parts, "/")
    if extension:
        whole = F.regexp_replace(whole, rf"\.{extension}$", "")
    own = F.array_append(folders, whole)
    keyed = prefixes.select(
        F.replace(F.col(prefix), F.lit("."), F.lit("/")).alias("__p"),
        F.col(prefix).alias("__dotted"),
        F.struct(F.col(pos).alias("pos"), F.col(owner).alias("owner")).alias("__own"),
    )
    by_path = (
        files.select(path, F.explode(own).alias("__p"))
        .join(keyed.select("__p", "__own"), "__p")
        .groupBy(path)
        .agg(F.min("__own")["owner"].alias("__o1"))
    )
    out = files.join(by_path, path, "left")
    if text:
        names = F.regexp_extract_all(text, F.lit(declared), F.lit(1))
        by_text = (
            files.select(path, F.posexplode(names).alias("__at", "__dotted"))
            .join(keyed.select("__dotted", "__own"), "__dotted")
            .groupBy(path)
            .agg(F.min_by(F.col("__own")["owner"], F.struct("__at", "__own")).alias("__o2"))
        )
        out = out.join(by_text, path, "left")
        return out.withColumn(owner, F.coalesce("__o1", "__o2")).drop("__o1", "__o2")
    return out.withColumnRenamed("__o1", owner)
