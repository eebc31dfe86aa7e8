"""MinHash near-duplicates by an inverted join over signature coordinates.

A document's set holds its distinct five-word shingles. Its signature has
``coordinates`` minima; every (coordinate, value) pair is a token, and two
documents whose sets are alike in 3/4 share most tokens. Pairs sharing at
least ``matches`` tokens are candidates, found without listing all pairs:

* documents of equal sets are one class and take part once;
* tokens that only one class has are dropped, and with them every class left
  with fewer than ``matches`` tokens;
* a class is posted under its rarest tokens only, all but ``matches - 1`` of
  them (prefix): two classes sharing ``matches`` tokens meet under one of
  these. The most frequent lists, such as those of a line that many documents
  share, are never merged but looked up in the signatures (skip);
* each list is compared with its hub, the member whose tokens are shared
  most, usually the text that the others were copied from. A class so gets
  one hub, the one it meets most often, and a group of thousands of near
  copies becomes one component at linear cost;
* what the hub did not link is looked for by rare shingles: members of one hub
  are posted under the rarest shingles that a partner must share, with how
  much can still be shared from there on. Where that is too little for any
  member of the list the posting goes, so texts that share a common template
  but not enough of the rest meet nowhere. Short lists give pairs; what is
  left in long ones is compared exactly, in blocks of bounded size that return
  only links between components;
* lists that still hold several components are compared across hubs, long
  ones in blocks, each pair in one list only.

Every candidate is confirmed on the full sets before it links. With 64
coordinates and 32 matches a pair of similarity 0.75 is missed with a
probability below 1e-5, one of 0.8 below 1e-9.

Rows without an id are returned unlinked (component NULL, kept). Rows of one
id count as one document. NULL and empty texts have no shingles and link with
nothing. Other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import only_ids, stored
from rowcast.llm.components import components
from rowcast.llm.shingles import minhash, set_prints, shingle_sets

COORDINATES = 64
MATCHES = 32
SHARE = 75
# Lists up to this length pair their members in the join; longer ones go by blocks.
SHORT_LIST = 32
BLOCK = 384


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coordinates: int = COORDINATES) -> DataFrame:
    """Per row: id, n_shingles, two prints that tell sets apart, the signature (NULL for an empty set)."""

    def sketch(batches):
        for batch in batches:
            ids = batch.column(0)
            for part, hashes, bounds in shingle_sets(batch.column(1)):
                sizes = np.diff(bounds)
                first, second = set_prints(hashes, bounds)
                rows = minhash(hashes, bounds, coordinates).view(np.int32)
                offsets = np.concatenate([[0], np.cumsum((sizes > 0) * coordinates)]).astype(np.int32)
                signature = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(rows.ravel()), mask=pa.array(sizes == 0)
                )
                yield pa.RecordBatch.from_arrays(
                    [ids[part.start : part.stop], pa.array(sizes), pa.array(first), pa.array(second), signature],
                    ["id", "n", "first", "second", "signature"],
                )

    return _texts(docs, id_col, text_col).mapInArrow(sketch, "id long, n long, first long, second long, signature array<int>")


def _sets(docs: DataFrame) -> DataFrame:
    """``(id, shingles)`` of rows ``(id, text)``."""

    def fill(batches):
        for batch in batches:
            for part, hashes, bounds in shingle_sets(batch.column(1)):
                sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start : part.stop], sets], ["id", "shingles"])

    return docs.mapInArrow(fill, "id long, shingles array<long>")


def _alike(pairs: DataFrame, signatures: DataFrame, matches: int, share: int) -> DataFrame:
    """Pairs whose signatures agree in ``matches`` places and whose sizes allow the similarity."""
    left = signatures.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    right = signatures.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))
    agreed = F.expr("size(filter(zip_with(s_a, s_b, (x, y) -> x = y), x -> x))")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * share
    return pairs.join(left, "a").join(right, "b").filter(fits).filter(agreed >= matches).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    return pairs.join(left, "a").join(right, "b").filter(both * 100 >= either * share).select("a", "b")


def _postings(classes: DataFrame, matches: int) -> DataFrame:
    """``(id, weight, places, prefix)``: every class with its rarest shared tokens.

    ``weight`` says how often the class's tokens are shared in all, ``places``
    has a bit for each coordinate of the prefix.
    """
    place = F.shiftleft(F.col("pos").cast("long"), 32)
    value = F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    tokens = classes.select("id", F.posexplode("signature")).select(place.bitwiseOR(value).alias("token"), "id")
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    ranked = (
        tokens.join(shared, "token")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("many", "token"))).alias("own"))
        .filter(F.size("own") >= matches)
    )
    weight = F.expr("aggregate(own, 0L, (s, x) -> s + x.many)")
    prefix = F.slice("own", 1, F.size("own") - (matches - 1))
    ranked = ranked.select("id", weight.alias("weight"), prefix.alias("prefix"))
    places = F.expr("aggregate(prefix, 0L, (s, x) -> s | shiftleft(1L, cast(shiftright(x.token, 32) AS int)))")
    # A token is there twice where rows of one id share it.
    return ranked.select("id", "weight", places.alias("places"), F.array_distinct("prefix.token").alias("prefix"))


def _joined_by(links, parts: dict) -> list[tuple[int, int]]:
    """Of ``(a, part of a, b, part of b)``, those that join parts not joined yet."""
    root = dict(parts)

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for a, part_a, b, part_b in links:
        one, two = find(part_a), find(part_b)
        if one != two:
            root[one] = two
            kept.append((min(a, b), max(a, b)))
    return kept


def _rare_lists(placed: DataFrame, share: int) -> DataFrame:
    """``(hub, token, many, id, component, size, left)``: members that may still find a partner, by shingle.

    Shingles are ordered by how many members of the hub have them, rarest
    first. A partner must share one of a member's first ``size - need + 1``,
    ``need`` being the least overlap of any pair at the similarity. ``left`` is
    how many of the member's shingles come at or after the posting: two members
    that first meet there share no more than the smaller of theirs.
    """
    size = F.size("shingles").cast("long")
    tokens = placed.select("hub", "id", "component", size.alias("size"), F.explode("shingles").alias("token"))
    shared = tokens.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    own = tokens.join(shared, ["hub", "token"]).groupBy("hub", "id").agg(
        F.min("component").alias("component"), F.min("size").alias("size"), F.array_sort(F.collect_list(F.struct("many", "token"))).alias("own")
    )
    alone = F.col("size") - F.size("own")
    need = F.ceil(F.col("size") * share / F.lit(100.0))
    prefix = (F.col("size") - need + 1 - alone).cast("int")
    lists = own.filter(prefix > 0).select("hub", "id", "component", "size", alone.alias("alone"), F.posexplode(F.slice("own", 1, prefix)).alias("pos", "one"))
    lists = lists.select("hub", F.col("one.token").alias("token"), "id", "component", "size", (F.col("size") - F.col("alone") - F.col("pos")).alias("left"))
    lists = stored(lists, "rare")
    for step in ("first", "second"):
        seen = lists.groupBy("hub", "token").agg(
            F.count(F.lit(1)).alias("many"), F.min("size").alias("smallest"), F.max("left").alias("most"),
            F.min("component").alias("low"), F.max("component").alias("high"),
        ).filter("low <> high")
        # Enough must be left on both sides for the smallest partner of the list.
        overlap = F.least("left", "most") * (100 + share) >= (F.col("size") + F.col("smallest")) * share
        lists = stored(lists.drop("many").join(seen, ["hub", "token"]).filter(overlap).select("hub", "token", "many", "id", "component", "size", "left"), step)
    counts = lists.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("many"), F.min("component").alias("low"), F.max("component").alias("high"))
    return lists.drop("many").join(counts.filter("low <> high").select("hub", "token", "many"), ["hub", "token"])


def _beside_hub(parts: DataFrame, sets: DataFrame, share: int, short: int, block: int) -> DataFrame:
    """Links between components among classes of one hub: ``parts(id, hub, component)``."""
    center = parts.select(F.col("id").alias("hub"), F.col("component").alias("center"))
    marked = parts.filter("id <> hub").join(center, "hub").withColumn("inner", F.col("component") == F.col("center"))
    open_hubs = marked.filter("NOT inner").select("hub", "center").distinct()
    # The hub belongs to its own members, whatever hub it has itself.
    own = open_hubs.select("hub", F.col("hub").alias("id"), F.col("center").alias("component"), F.lit(True).alias("inner"))
    members = marked.join(open_hubs, "hub", "left_semi").select("hub", "id", "component", "inner").unionByName(own)
    # Every plan is kept short: its exchanges run side by side and the driver holds what belongs to each.
    placed = stored(members.join(sets.select("id", "shingles"), "id"), "placed")
    lists = stored(_rare_lists(placed, share), "lists")
    brief = lists.filter(F.col("many") <= short)
    other = brief.select("hub", "token", F.col("id").alias("b"), F.col("component").alias("beside"), F.col("size").alias("size_b"), F.col("left").alias("left_b"))
    met = brief.withColumnRenamed("id", "a").join(other, ["hub", "token"]).filter("a < b AND component <> beside")
    enough = F.least("left", "left_b") * (100 + share) >= (F.col("size") + F.col("size_b")) * share
    links = _confirmed(met.filter(enough).select("a", "b").distinct(), sets, share)
    busy = lists.filter(F.col("many") > short).select("hub", "id").distinct()
    return links.unionByName(_in_blocks(placed.join(busy, ["hub", "id"], "left_semi"), share, block))


def _in_blocks(placed: DataFrame, share: int, block: int) -> DataFrame:
    """Links between components among ``placed(hub, id, component, inner, shingles)``.

    Members outside the hub's component are dealt into blocks and compared
    with every block; members inside it only with those outside.
    """
    size = F.size("shingles").cast("long")
    room = lambda side: F.greatest(
        F.ceil(F.count(F.when(side, 1)) / block), F.ceil(F.coalesce(F.sum(F.when(side, size)), F.lit(0)) / (block * 4096))
    ).cast("int")
    blocks = placed.groupBy("hub").agg(room(~F.col("inner")).alias("outer_blocks"), room(F.col("inner")).alias("inner_blocks"))
    dealt = placed.join(blocks.filter("outer_blocks > 0"), "hub")
    outer = F.pmod(F.xxhash64("id"), F.greatest("outer_blocks", F.lit(1))).cast("int")
    inner = F.col("outer_blocks") + F.pmod(F.xxhash64("id"), F.greatest("inner_blocks", F.lit(1))).cast("int")
    dealt = dealt.withColumn("own", F.when(F.col("inner"), inner).otherwise(outer))
    last = F.when(F.col("inner"), F.col("outer_blocks")).otherwise(F.col("outer_blocks") + F.col("inner_blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last - 1))).select(
        "hub", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "id", "component", "shingles",
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        low = group[group["own"] == group["low"]]
        high = group[group["own"] == group["high"]]
        if not len(low) or not len(high):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        sizes = high["shingles"].map(len).to_numpy()
        every = np.concatenate(high["shingles"].to_list())
        owner = np.repeat(np.arange(len(high)), sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        ids, parts = high["id"].to_numpy(), high["component"].to_numpy()
        links = []
        for own, part, one in zip(low["id"], low["component"], low["shingles"]):
            first = np.searchsorted(every, one, "left")
            count = np.searchsorted(every, one, "right") - first
            spots = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            both = np.bincount(owner[spots], minlength=len(high))
            good = (100 * both >= share * (len(one) + sizes - both)) & (parts != part)
            links += [(own, part, ids[j], parts[j]) for j in np.flatnonzero(good)]
        return pd.DataFrame(_joined_by(links, {}), columns=["a", "b"]).astype("int64")

    return dealt.groupBy("hub", "low", "high").applyInPandas(compare, "a long, b long")


def _blockwise(lists: DataFrame, matches: int, block: int) -> DataFrame:
    """Pairs across components and hubs of long lists, by blocks against blocks of one list."""
    blocks = F.ceil(F.col("many") / block).cast("int")
    rows = lists.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "token", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "id", "hub", "component", "places", "signature",
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        low = group[group["own"] == group["low"]]
        high = group[group["own"] == group["high"]]
        if not len(low) or not len(high):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        coordinate = int(group["token"].iat[0]) >> 32
        right = np.stack(high["signature"].to_numpy())
        bits = np.arange(right.shape[1], dtype=np.uint64)
        masks = lambda side: (side["places"].to_numpy().view(np.uint64)[:, None] >> bits & np.uint64(1)).astype(bool)
        beside, ids = masks(high), high["id"].to_numpy()
        parts, hubs = high["component"].to_numpy(), high["hub"].to_numpy()
        found = []
        for own, part, hub, signature, mask in zip(low["id"], low["component"], low["hub"], low["signature"], masks(low)):
            same = right == signature
            # A pair counts in the list of the first prefix coordinate it shares.
            lead = (same & beside & mask).argmax(axis=1) == coordinate
            good = lead & (same.sum(axis=1) >= matches) & (parts != part) & (hubs != hub)
            found += [(min(own, other), max(own, other)) for other in ids[good]]
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"]).astype("int64")

    return dealt.groupBy("token", "low", "high").applyInPandas(compare, "a long, b long")


def _across(postings: DataFrame, members: DataFrame, signatures: DataFrame, matches: int, short: int, block: int) -> DataFrame:
    """Distinct pairs of different components and hubs that meet in a list."""
    marked = stored(postings.join(members, "id").select("token", "id", "places", "hub", "component"), "marked")
    mixed = (
        marked.groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("many"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.min("hub").alias("first_hub"),
            F.max("hub").alias("last_hub"),
        )
        .filter("least <> most AND first_hub <> last_hub")
        .select("token", "many")
    )
    lists = stored(marked.join(mixed, "token"), "mixed")
    brief = lists.filter(F.col("many") <= short)
    other = brief.select("token", F.col("id").alias("b"), F.col("component").alias("beside"), F.col("hub").alias("other_hub"))
    pairs = brief.withColumnRenamed("id", "a").join(other, "token")
    pairs = pairs.filter("a < b AND component <> beside AND hub <> other_hub").select("a", "b")
    long = lists.filter(F.col("many") > short).join(signatures.select("id", "signature"), "id")
    return pairs.unionByName(_blockwise(long, matches, block)).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
    share: int = SHARE,
    short_list: int = SHORT_LIST,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id, kept (see the module's text)."""
    drawn = stored(sketches(docs, id_col, text_col, coordinates), "sketches")
    # One class per distinct set, named by its smallest id; sizes and signatures of equal sets are equal.
    named = drawn.filter("id IS NOT NULL AND n > 0")
    classes = named.groupBy("first", "second").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = stored(classes, "classes")
    named_by = classes.select("first", "second", F.col("id").alias("class"))
    members = named.select("id", "first", "second").join(named_by, ["first", "second"]).select("id", "class").filter("id <> class")
    prefixes = stored(_postings(classes, matches), "prefixes")
    nodes = prefixes.select("id")
    postings = prefixes.select("id", "weight", "places", F.explode("prefix").alias("token"))
    sets = stored(_sets(only_ids(_texts(docs, id_col, text_col), nodes, "id")), "sets")
    signatures = stored(classes.select("id", "n", "signature").join(nodes, "id", "left_semi"), "shared")

    hub = F.max_by("id", F.struct("weight", (-F.col("id")).alias("low"))).alias("hub")
    hubs = postings.groupBy("token").agg(hub)
    # Dealt by id once, for the counts and for the choice among them; a class is its own hub where it meets no other.
    met = postings.join(hubs, "token").select("id", "hub").repartition("id").groupBy("id", "hub").agg(F.count(F.lit(1)).alias("met"))
    nearest = F.max_by("hub", F.struct((F.col("id") != F.col("hub")).alias("other"), "met", (-F.col("hub")).alias("low")))
    best = stored(met.groupBy("id").agg(nearest.alias("hub")), "hubs")
    star = best.filter("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
    links = stored(_confirmed(_alike(star, signatures, matches, share), sets, share), "links")

    def labelled(edges: DataFrame) -> DataFrame:
        joined = components(edges).withColumnRenamed("node", "id")
        parts = best.join(joined, "id", "left").select("id", "hub", F.coalesce("component", "id").alias("component"))
        return stored(parts, "parts")

    def spokes(parts: DataFrame) -> DataFrame:
        """Found components as edges from their smallest id, which need no rounds of their own."""
        return parts.filter("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))

    parts = labelled(links)
    links = stored(_beside_hub(parts, sets, share, short_list, block), "links")
    parts = labelled(spokes(parts).unionByName(links))
    pairs = stored(_across(postings, parts, signatures, matches, short_list, block), "pairs")
    links = stored(_confirmed(_alike(pairs, signatures, matches, share), sets, share), "links")

    linked = spokes(parts).unionByName(links).unionByName(members.select(F.col("class").alias("a"), F.col("id").alias("b")))
    linked = components(linked)
    out = drawn.select(F.col("id").alias("node"), "n").join(linked, "node", "left")
    component = F.coalesce("component", "node")
    return out.select(
        F.col("node").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("node"), F.lit(True)).alias("kept"),
    )
