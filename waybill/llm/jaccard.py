"""Groups of texts whose sets of word n-grams are nearly equal, by adaptive multi-match prefixes.

A text's set is its distinct runs of `width` words. Two texts link when |x ∩ y| / |x ∪ y| is at least the threshold t;
the result has the connected components of all links. The join is exact: nothing is sampled or capped.

1. Texts with equal sets are one class from the start, so copies never meet in a join.
2. Of the n tokens of x at least ⌈t·n⌉ are in any y that links with it, so a class with n - ⌈t·n⌉ + 1 tokens that no other
   class has links with nothing. The tokens with the lowest hashes are enough to find most of these. Rounds over the
   classes that are left, the open ones, find more, as tokens are shared by fewer. Only the last open ones, which
   nearly all have a copy or are very short, are read in full. Their tokens have one order for all, rare before frequent: x and y
   share a token of their first n - ⌈t·n⌉ + 1.
3. A pair that links also shares l tokens of the first n - ⌈t·n⌉ + l. Each class takes the l for which the join and the
   comparisons after it are estimated to cost least, from the frequencies in its prefix: long posting lists make it
   lengthen the prefix and ask for more shared tokens. A pair must share as many as the lesser l of the two, and enough
   to reach the overlap its sizes call for with all that lies beyond the prefixes.
   Each class also has a parity of its tokens in 512 bits: two sets differ in as many tokens as their parities do in
   bits at least, which rules out most other pairs inside the join.
4. Within tokens of many classes, each is first compared with one pivot only. Classes that this connects need no
   comparison with one another, as only components are asked for; all other pairs that pass the filter are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graphs import component_roots
from .shared import Landing, broadcast_if_small
from .words import Hasher, mixed, shingle_hashes, slices, word_hashes

MOST_MATCHES = 16  # shared tokens asked for at most
WORDS = 8  # of 64 bits in a class's parity
BITS = tuple(f"bits{i}" for i in range(WORDS))
ROUNDS = 5  # over the low tokens at most
PIVOT_FROM = 24  # classes from which a token's group gets a pivot


def token_sets(words: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text of a batch."""
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield np.unique(shingle_hashes(words[a:b], width))


def set_key(tokens: np.ndarray) -> int:
    return int(mixed(np.array([np.sum(mixed(tokens + np.uint64(1)), dtype=np.uint64)]))[0].astype(np.int64))


def parities(tokens: np.ndarray) -> tuple[int, ...]:
    """For each of 512 bits, whether an odd number of tokens falls on it; as signed words of 64 bits."""
    odd = np.bincount((tokens >> np.uint64(7)).astype(np.int64) & 511, minlength=512) & 1
    return tuple(np.packbits(odd.astype(np.uint8)).view(np.int64).tolist())


def _lists(values: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values).astype(np.int64) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def _set_reader(width: int, low: int | None):
    """Rows (id, text) to (id, n, key, tokens, parities), all tokens or, with `low`, those below it and no parities.

    Rows may have a third column, the key they are wanted for; texts with another one are left out.
    """

    def read(batches):
        hasher = Hasher(fold=True)
        for batch in slices(batches):
            words, bounds = word_hashes(batch.column(1), hasher)
            sizes, keys, kept, bits = [], [], [], []
            for tokens in token_sets(words, bounds, width):
                sizes.append(len(tokens))
                bits.append(parities(tokens) if low is None else None)
                keys.append(set_key(tokens) if len(tokens) else None)
                kept.append(tokens if low is None else tokens[: np.searchsorted(tokens, np.uint64(low))])
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), _lists(kept)]
            columns += [pa.array([b and b[i] for b in bits], pa.int64()) for i in range(WORDS)]
            read_rows = pa.RecordBatch.from_arrays(columns, ["id", "n", "key", "tokens", *BITS])
            if batch.num_columns > 2:
                read_rows = read_rows.filter(pc.equal(columns[2], batch.column(2)))
            yield read_rows

    return read


def _prefixes(num: int, den: int):
    """Rows (key, n, own, dfs, tokens) to (key, n, held, matches, last, tokens): the prefix of least estimated cost.

    `own` tokens come first in the order and join with nothing; `dfs` and `tokens` list the others. With l matches
    asked for, the frequencies of those in the prefix sum up to S rows in the join and to at most S / l pairs that
    match l times; comparing a pair costs about an eighth of the set's size in rows.
    """

    def choose(batches):
        for batch in batches:
            n, own = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            held, matches, last, kept = [], [], [], []
            for i in range(len(n)):
                dfs, tokens = batch.column(3)[i].values.to_numpy(), batch.column(4)[i].values.to_numpy()
                need = -(-num * int(n[i]) // den)
                first = int(n[i]) - need + 1 - int(own[i])
                asked = np.arange(1, min(MOST_MATCHES, need) + 1)
                total = np.cumsum(dfs - 1)[first + asked - 2]
                best = int(np.argmin(total + total / asked * (4 + n[i] / 8)))
                count = first + best
                held.append(int(own[i]) + count)
                matches.append(best + 1)
                last.append((int(dfs[count - 1]), int(tokens[count - 1])))
                kept.append(tokens[:count])
            ends = [pa.array([e[j] for e in last], pa.int64()) for j in range(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(held, pa.int64()), pa.array(matches, pa.int32()),
                 pa.StructArray.from_arrays(ends, ["df", "token"]), _lists(kept)],
                ["key", "n", "held", "matches", "last", "tokens"],
            )

    return choose


def _linked(num: int, den: int):
    """Rows (u, v, a, b) with sorted token sets to the (u, v) that link."""

    def compare(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                at = np.searchsorted(a, b)
                shared = int(np.count_nonzero(a[np.minimum(at, len(a) - 1)] == b))
                keep.append(den * shared >= num * (len(a) + len(b) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return compare


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    sorted_sets = sets.select("key", F.sort_array("tokens").alias("tokens"))
    a = sorted_sets.toDF("u", "a")
    b = sorted_sets.toDF("v", "b")
    rows = pairs.select("u", "v").join(a, "u").join(b, "v").select("u", "v", "a", "b")
    return rows.mapInArrow(_linked(num, den), "u long, v long")


def _alike(a: str, b: str, num: int, den: int):
    """Whether parities leave room for a link: sizes x and y allow (x + y)(1 - t) / (1 + t) different tokens."""
    apart = sum((F.bit_count(F.col(a.format(c)).bitwiseXOR(F.col(b.format(c)))) for c in BITS[1:]),
                F.bit_count(F.col(a.format(BITS[0])).bitwiseXOR(F.col(b.format(BITS[0])))))
    return apart * (num + den) <= (F.col(a.format("n")) + F.col(b.format("n"))) * (den - num)


def _candidates(entries: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes of different components that share enough prefix tokens.

    Of two prefixes, every common token of the one that ends first in the order is in the other too. So the sets
    share at most the tokens found and those beyond that prefix, and no more than either has after the last one found;
    together they must reach the overlap the sizes call for.
    """
    entries = entries.join(labels.toDF("key", "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    columns = ("key", "n", "matches", "root", "held", "last", "place", *BITS)
    a = entries.select("token", *[F.col(c).alias(f"a_{c}") for c in columns])
    b = entries.select("token", *[F.col(c).alias(f"b_{c}") for c in columns])
    near = (F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num) & (F.col("a_root") != F.col("b_root"))
    near = near & _alike("a_{}", "b_{}", num, den)
    pairs = a.join(b, (a["token"] == b["token"]) & (F.col("a_key") < F.col("b_key")) & near)
    beyond = F.when(F.col("a_last") <= F.col("b_last"), F.col("a_n") - F.col("a_held")).otherwise(F.col("b_n") - F.col("b_held"))
    behind = lambda c: F.min(F.col(f"{c}_n") - F.col(f"{c}_place"))  # noqa: E731  tokens after the last one shared
    counted = pairs.groupBy(F.col("a_key").alias("u"), F.col("b_key").alias("v")).agg(
        F.count(F.lit(1)).alias("shared"), F.min(F.least("a_matches", "b_matches")).alias("asked"),
        F.least(F.min(beyond), behind("a"), behind("b")).alias("beyond"), F.min(F.col("a_n") + F.col("b_n")).alias("sizes"),
    )
    enough = (F.col("shared") + F.col("beyond")) * (num + den) >= F.col("sizes") * num
    return counted.where((F.col("shared") >= F.col("asked")) & enough).select("u", "v")


def _sets_of(rows: DataFrame, wanted: DataFrame, reader, schema: str) -> DataFrame:
    """(key, n, tokens, parities) of the classes in `wanted(key, rep)`, read from the rows of their representatives."""
    wanted = broadcast_if_small(wanted.toDF("wanted", "rep"))
    texts = rows.join(wanted, F.col("id").eqNullSafe(F.col("rep"))).select("id", "text", "wanted")
    return texts.mapInArrow(reader, schema).select("key", "n", "tokens", *BITS)


def _own_tokens(tokens: DataFrame) -> DataFrame:
    """(key, own): how many of the given tokens no other class has."""
    single = tokens.groupBy("token").agg(F.min("key").alias("key"), F.max("key").alias("high")).where("key = high")
    return single.groupBy("key").agg(F.count(F.lit(1)).alias("own"))


def _open_rounds(profiles: DataFrame, classes: DataFrame, landing: Landing, prefix) -> DataFrame:
    """(key, rep, n) of the classes that may still link, as the low tokens tell."""
    tokens = profiles.where("n > 0").select("key", F.explode("tokens").alias("token"))
    left = classes.join(_own_tokens(tokens), "key", "left").where(F.coalesce("own", F.lit(0)) < prefix)
    left = landing.land(left.select("key", "rep", "n"), "open-0")
    chosen = broadcast_if_small(left.select(F.col("key").alias("wanted"), "rep"))
    same = (F.col("key") == F.col("wanted")) & F.col("id").eqNullSafe(F.col("rep"))
    sets = landing.land(profiles.join(chosen, same).select("key", "tokens"), "open-sets")
    count = left.count()
    for i in range(1, ROUNDS + 1):
        tokens = sets.join(broadcast_if_small(left.select("key")), "key", "left_semi")
        tokens = tokens.select("key", F.explode("tokens").alias("token"))
        less = left.join(_own_tokens(tokens), "key", "left").where(F.coalesce("own", F.lit(0)) < prefix)
        left = landing.land(less.select("key", "rep", "n"), f"open-{i}")
        before, count = count, left.count()
        if count > 0.8 * before:
            break
    return left


def _entries(sets: DataFrame, landing: Landing, num: int, den: int, prefix) -> DataFrame:
    """A row for every shared token of the prefix of every open class."""
    tokens = sets.select("key", "n", F.explode("tokens").alias("token"))
    counted = landing.land(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    shared = tokens.join(counted, "token").groupBy("key", "n").agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("common"))
    rows = shared.withColumn("own", F.col("n") - F.size("common")).where(F.col("own") < prefix)
    prefixes = rows.select("key", "n", "own", "common.df", "common.token").mapInArrow(
        _prefixes(num, den), "key long, n long, held long, matches int, last struct<df:long,token:long>, tokens array<long>"
    )
    prefixes = prefixes.select("*", F.posexplode("tokens").alias("at", "token"))
    place = (F.col("held") - F.size("tokens") + F.col("at") + 1).alias("place")
    prefixes = prefixes.select("key", "n", "held", "matches", "last", "token", place)
    return landing.land(prefixes.join(sets.select("key", *BITS).dropDuplicates(["key"]), "key"), "entries")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, threshold: tuple[int, int] = (90, 100),
    landing: Landing | None = None,
) -> DataFrame:
    """(id, n_shingles, component_id) for each row of `docs`, for all links of the given similarity.

    Texts are lower-cased (A-Z) and split at `\\x20\\x09-\\x0D`; a text with fewer than `width` words has them all as
    its one n-gram. Null, empty and blank texts have no n-gram, link with nothing and are their own component. Equal
    texts are one component, rows with the same id and text too. A row without id takes part, but the component is
    named by the smallest id in it, null if none has one. Other columns are ignored; an empty table gives an empty one.
    """
    num, den = threshold
    landing = landing or Landing(docs.sparkSession, "jaccard")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n long, key long, tokens array<long>, " + ", ".join(f"{b} long" for b in BITS)
    low = min((1 << 63) - 1, (1 << 64) * 2 * (den - num) // den)
    profiles = landing.land(rows.mapInArrow(_set_reader(width, low), schema), "profiles")
    classes = profiles.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.max("n").alias("n"))
    prefix = F.expr(f"n - ceil({num} * n / {den}) + 1").cast("long")
    open_classes = _open_rounds(profiles, classes, landing, prefix)
    sets = landing.land(_sets_of(rows, open_classes.select("key", "rep"), _set_reader(width, None), schema), "sets")
    entries = _entries(sets, landing, num, den, prefix)

    hub = F.max_by(F.struct("key", "n", *BITS), F.struct("last", "key"))
    pivots = entries.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), hub.alias("hub")).where(F.col("rows") >= PIVOT_FROM)
    spokes = entries.join(pivots, "token").where((F.col("key") != F.col("hub.key")) & _alike("{}", "hub.{}", num, den))
    spokes = landing.land(spokes.select(F.col("key").alias("u"), F.col("hub.key").alias("v")).distinct(), "spokes")
    hubs = landing.land(_verified(spokes, sets, num, den), "hub-links")
    labels = landing.land(component_roots(hubs, landing, "hubs"), "labels")
    pairs = landing.land(_candidates(entries, labels, num, den), "pairs")
    links = landing.land(_verified(pairs, sets, num, den), "pair-links")
    links = links.unionByName(labels.select(F.col("node").alias("u"), F.col("root").alias("v")))
    roots = landing.land(component_roots(links, landing, "all"), "roots")

    members = roots.join(classes.select("key", "rep"), roots["node"] == F.col("key"))
    lowest = members.groupBy("root").agg(F.min("rep").alias("named"))
    named = members.join(lowest, "root").select("key", "named")
    names = classes.join(named, "key", "left").select("key", F.coalesce("named", "rep").alias("component_id"))
    result = profiles.select("id", "n", "key").join(names, "key", "left")
    return result.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def distinct_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (80, 100)
) -> DataFrame:
    """The rows of `docs`, with all their columns, that name their component: one of each group of near copies.

    Rows that share an id stay or go together; of those that agree in text too, one stays, the first by a hash of its
    columns. Rows without id stay.
    """
    landing = Landing(docs.sparkSession, "distinct")
    inner = Landing(docs.sparkSession, "jaccard")
    groups = jaccard_components(docs, id_col, text_col, width, threshold, inner)
    groups = landing.land(groups.toDF("of", "n", "component_id"), "groups")
    inner.close()
    gone = groups.where("of is not null").groupBy("of").agg(F.max(F.col("of") == F.col("component_id")).alias("stays"))
    gone = broadcast_if_small(landing.land(gone.where(~F.col("stays")).select("of"), "gone"))
    kept = docs.join(gone, docs[id_col] == gone["of"], "left_anti")
    repeated = landing.land(groups.groupBy("of").count().where("of is not null and count > 1").select("of"), "repeated")
    if repeated.isEmpty():
        return kept
    told = [c for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]  # maps have no hash
    first = Window.partitionBy(id_col, text_col).orderBy(F.xxhash64(*told), F.xxhash64(F.lit(1), *told))
    copies = kept.join(repeated, kept[id_col] == repeated["of"], "left_semi").withColumn("_copy_of_a_row", F.row_number().over(first))
    once = copies.where(F.col("_copy_of_a_row") == 1).drop("_copy_of_a_row")
    return kept.join(repeated, kept[id_col] == repeated["of"], "left_anti").unionByName(once)
