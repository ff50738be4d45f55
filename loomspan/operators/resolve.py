"""Entity resolution: seed lookup, blocking, exact and fuzzy links, components, canonical names, mapping log."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions import names, similarity
from loomspan.operators import simjoin
from loomspan.plans.components import components
from loomspan.plans.ranks import group_ranks
from loomspan.plans.scratch import Scratch
from loomspan.sources.seed import seed_lookup

#: Prefix blocks with more members are skipped; key and word blocks never are.
MAX_PREFIX_BLOCK = 500
CONFIDENT, BORDERLINE = 98.0, 75.0
#: Blocks with more members are frequent where pairs are counted.
FREQUENT_BLOCK = 128
#: Names in one piece of a listing of variants.
RUN = 4096
#: A decision links two names from this score on and below CONFIDENT.
SCOPES = (("startups", "entity_name", "STARTUP", "Y Combinator"), ("products", "startup_name", "PRODUCT", "SaaSHub"), ("jobs", "company", "JOB", "Job Board"))


def scoped_entities(tables: dict[str, DataFrame]) -> DataFrame:
    """(entity_id, raw_name, entity_type, source_name, source_url) of every non-blank name, startups before products before jobs.

    An id is the branch over the row's own id, so ids keep the order of the
    tables without a global sort.
    """
    out = None
    for branch, (table, column, kind, source) in enumerate(SCOPES):
        if table not in tables:
            continue
        rows = tables[table].where(F.trim(F.col(column)) != "").select(
            (F.lit(branch << 56) + F.col("id")).cast("long").alias("entity_id"),
            F.col(column).alias("raw_name"),
            F.lit(kind).alias("entity_type"),
            F.coalesce(F.nullif(F.col("source_name"), F.lit("")), F.lit(source)).alias("source_name"),
            F.col("source_url"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def normalise(entities: DataFrame) -> DataFrame:
    """entities with clean_name, match_key and seed_canonical. The lookup holds the seed list, a constant, so it is broadcast."""
    clean = names.display_name(F.col("raw_name"))
    out = entities.withColumn("clean_name", clean).withColumn("match_key", names.match_key(F.col("clean_name")))
    seed = seed_lookup(entities.sparkSession)
    by_raw = seed.select(F.col("seed_key").alias("_raw_key"), F.col("canonical").alias("_by_raw"))
    by_clean = seed.select(F.col("seed_key").alias("_clean_key"), F.col("canonical").alias("_by_clean"))
    out = out.withColumns({"_rk": names.seed_key(F.col("raw_name")), "_ck": names.seed_key(F.col("clean_name"))})
    out = out.join(F.broadcast(by_raw), F.col("_rk") == F.col("_raw_key"), "left").join(F.broadcast(by_clean), F.col("_ck") == F.col("_clean_key"), "left")
    return out.withColumn("seed_canonical", F.coalesce("_by_raw", "_by_clean")).drop("_rk", "_ck", "_raw_key", "_clean_key", "_by_raw", "_by_clean")


def _blocks(entities: DataFrame) -> DataFrame:
    return entities.select("entity_id", F.explode(names.blocking_keys(F.col("match_key"), F.col("clean_name"))).alias("block_key"))


def large_prefixes(entities: DataFrame, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """(block_key) of the prefix blocks with more members than that, which count as no blocks. Counts are summed before the shuffle."""
    return _blocks(entities).where(F.col("block_key").startswith("pref:")).groupBy("block_key").agg(F.count("*").alias("n")).where(F.col("n") > max_prefix).select("block_key")


def block_index(entities: DataFrame, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """(block_key, entity_id) without oversized prefix blocks."""
    return _blocks(entities).join(large_prefixes(entities, max_prefix), "block_key", "left_anti").select("block_key", "entity_id")


def sharing_block(pairs: DataFrame, entities: DataFrame, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """The pairs (clean_a, key_a, clean_b, key_b and more) whose names share a block.

    A shared key or word settles it for the pair alone; only pairs that share
    nothing but a prefix are held against the oversized ones.
    """
    a, b = (names.blocking_keys(F.col(f"key_{x}"), F.col(f"clean_{x}")) for x in "ab")
    rows = pairs.withColumn("_shared", F.array_intersect(a, b)).where(F.size("_shared") > 0)
    by_prefix = ~F.exists("_shared", lambda k: ~k.startswith("pref:"))
    alone = rows.where(by_prefix).withColumn("block_key", F.get("_shared", F.lit(0))).join(large_prefixes(entities, max_prefix), "block_key", "left_anti").drop("block_key")
    return rows.where(~by_prefix).unionByName(alone).drop("_shared")


def candidate_pairs(entities: DataFrame, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """Distinct (id_a, id_b) with id_a < id_b that share a block: the full pair set, as large as its blocks make it.

    The resolver does not build it; it is there to be counted and looked at.
    """
    index = block_index(entities, max_prefix)
    a, b = (index.select("block_key", F.col("entity_id").alias(x)) for x in ("id_a", "id_b"))
    return a.join(b, "block_key").where("id_a < id_b").select("id_a", "id_b").distinct()


def star_links(entities: DataFrame, column: str) -> DataFrame:
    """(a, b): every entity with a non-empty value, linked to the value's first entity. As many links as rows, however large a group."""
    rows = entities.where((F.col(column).isNotNull()) & (F.col(column) != ""))
    first = rows.groupBy(column).agg(F.min("entity_id").alias("a"), F.count("*").alias("n")).where("n > 1").select(column, "a")
    return rows.join(first, column).where(F.col("entity_id") != F.col("a")).select("a", F.col("entity_id").alias("b"))


def score_pairs(pairs: DataFrame, a: str = "clean_a", b: str = "clean_b") -> DataFrame:
    """pairs with token_sort, ratio and tier: 2 for a confident match, 3 for a borderline one, null otherwise."""
    x, y = F.col(a), F.col(b)
    scored = pairs.withColumns({"token_sort": similarity.token_sort_ratio(x, y), "ratio": similarity.ratio(x, y)})
    confident = (F.col("token_sort") >= CONFIDENT) & (F.col("ratio") >= CONFIDENT)
    borderline = (F.col("token_sort") >= BORDERLINE) & (F.col("token_sort") < CONFIDENT)
    return scored.withColumn("tier", F.when(confident, F.lit(2)).when(borderline, F.lit(3)))


def _distinct_names(entities: DataFrame) -> DataFrame:
    """One row for each clean name: its first entity and key."""
    return entities.where("clean_name != ''").groupBy("clean_name", "match_key").agg(F.min("entity_id").alias("entity_id"))


def _named_pairs(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b) with the clean names and keys of both, which differ."""
    a, b = (found.select(F.col("entity_id").alias(x), F.col("clean_name").alias(f"clean_{x}"), F.col("match_key").alias(f"key_{x}")) for x in "ab")
    return pairs.select("a", "b").join(a, "a").join(b, "b").where("key_a != key_b")


def fuzzy_links(entities: DataFrame, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """(a, b) of names that share a block and match confidently.

    A ratio of 98 leaves room for an edit only from 50 characters in both names
    on. So names go into the join once each, only if long enough, and are joined
    by the segments that such edits leave whole, not by the words that they share;
    whether a pair shares a block is asked of the few pairs that are left.
    """
    found = _distinct_names(entities).where(F.length("clean_name") >= 24)
    near = simjoin.segment_join(found.select(F.col("entity_id").alias("id"), F.col("clean_name").alias("text")), int(CONFIDENT))
    confident = score_pairs(_named_pairs(near, found)).where("tier = 2")
    return sharing_block(confident, entities, max_prefix).select("a", "b")


def decided_links(entities: DataFrame, decisions: DataFrame, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """(a, b) of borderline names that an arbiter's decisions (clean_a, clean_b, is_same) call the same, if they share a block."""
    found = _distinct_names(entities)
    yes = decisions.where("is_same").select("clean_a", "clean_b").distinct()
    pairs = yes.join(found.select(F.col("clean_name").alias("clean_a"), F.col("entity_id").alias("a")), "clean_a").join(
        found.select(F.col("clean_name").alias("clean_b"), F.col("entity_id").alias("b")), "clean_b"
    )
    scored = score_pairs(pairs.where("a != b")).where("tier = 3").select("a", "b")
    index = block_index(entities, max_prefix)
    left, right = index.select("block_key", F.col("entity_id").alias("a")), index.select("block_key", F.col("entity_id").alias("b"))
    return scored.join(left, "a").join(right, ["b", "block_key"]).select("a", "b").distinct()


def borderline_pairs(entities: DataFrame, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """(clean_a, clean_b, token_sort, ratio): distinct names for the arbiter, clean_a that of the earlier entity.

    Names that share a word or a prefix are compared in tiles of bounded size
    (see ``simjoin.block_join``). Names of one key are linked already and left out.
    """
    found = Scratch(entities.sparkSession, "borderline").keep(_distinct_names(entities))
    blocks = block_index(entities, max_prefix).where(~F.col("block_key").startswith("key:")).join(found.select("entity_id"), "entity_id", "left_semi")
    # clean names have single spaces, so sorting their words keeps their lengths
    texts = found.select(F.col("entity_id").alias("id"), similarity.sorted_tokens(F.col("clean_name")).alias("text"))
    near = simjoin.block_join(texts, blocks.select(F.col("entity_id").alias("id"), F.col("block_key").alias("block")), int(BORDERLINE))
    return score_pairs(_named_pairs(near, found)).where("tier = 3").select("clean_a", "clean_b", "token_sort", "ratio")


def clusters(entities: DataFrame, decisions: DataFrame | None = None, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """entities (normalised) with ``root``, the least entity_id connected by seed, key, fuzzy or decided links."""
    links = star_links(entities, "seed_canonical").unionByName(star_links(entities, "match_key"))
    links = links.unionByName(fuzzy_links(entities, max_prefix))
    if decisions is not None:
        links = links.unionByName(decided_links(entities, decisions, max_prefix))
    # a fuzzy or decided link names a clean name's first entity; same names share a key, or have none and stay apart
    roots = components(links, label="entities")
    return entities.join(roots.withColumnRenamed("id", "entity_id"), "entity_id", "left").withColumn("root", F.coalesce("component", "entity_id")).drop("component")


def canonical_names(clustered: DataFrame) -> DataFrame:
    """(root, canonical_name, members): by seed, then the directory's first name, then the product site's, then the commonest, shortest, least name."""
    counts = clustered.where("clean_name != ''").groupBy("root", "clean_name").agg(F.count("*").alias("n"))
    usual = counts.groupBy("root").agg(F.min(F.struct((-F.col("n")).alias("a"), F.length("clean_name").alias("b"), F.col("clean_name").alias("c"))).alias("u"))

    def first(column: str, test) -> F.Column:
        return F.min_by(column, F.when(test, F.col("entity_id")))

    named = F.col("clean_name") != ""
    votes = clustered.groupBy("root").agg(
        F.count("*").alias("members"),
        first("seed_canonical", F.col("seed_canonical").isNotNull()).alias("s"),
        first("clean_name", named & (F.col("source_name") == "Y Combinator")).alias("y"),
        first("clean_name", named & (F.col("source_name") == "SaaSHub")).alias("h"),
        F.min_by("raw_name", "entity_id").alias("r"),
    )
    return votes.join(usual.select("root", F.col("u.c").alias("c")), "root", "left").select("root", F.coalesce("s", "y", "h", "c", "r").alias("canonical_name"), "members")


def mapping_log(clustered: DataFrame, canonical: DataFrame) -> DataFrame:
    """One row for each entity: canonical name, match method, confidence and explanation."""
    # The methods' names and the explanations.
    joined = clustered.join(canonical, "root")
    single, seeded = F.col("members") == 1, F.col("seed_canonical").isNotNull()
    same = F.lower("clean_name") == F.lower("canonical_name")
    method = F.when(seeded, F.lit("SEED_LIST_MATCH")).when(single, F.lit("CANONICAL_SINGLETON")).when(same, F.lit("EXACT_NORMALIZED")).otherwise(F.lit("FUZZY_CONFIDENT"))
    name = F.col("canonical_name")
    why = (
        F.when(single & seeded, F.concat(F.lit("Matched Tier 0 AI Startup Seed List canonical '"), F.col("seed_canonical"), F.lit("'")))
        .when(single, F.lit("Unique entity representation"))
        .when(seeded, F.concat(F.lit("Merged into Seed List canonical '"), name, F.lit("'")))
        .when(same, F.concat(F.lit("Identical to canonical entity name '"), name, F.lit("'")))
        .otherwise(F.concat(F.lit("Resolved to canonical entity '"), name, F.lit("' via cluster similarity")))
    )
    return joined.select(
        "entity_id", "raw_name", "canonical_name", "entity_type", method.alias("match_method"),
        F.when(method == "FUZZY_CONFIDENT", F.lit(0.95)).otherwise(F.lit(1.0)).alias("confidence"), "source_name", "source_url", why.alias("explanation"),
    )


def resolve(entities: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """The mapping log of all scoped entities. Without decisions borderline names stay apart."""
    scratch = Scratch(entities.sparkSession, "resolve")
    ready = scratch.keep(normalise(entities))
    clustered = scratch.keep(clusters(ready, decisions))
    return mapping_log(clustered, canonical_names(clustered))


def logged(log: DataFrame, resolved_at: Column) -> DataFrame:
    """The mapping log as its table has it: numbered from 1 in the order of the entities, with the time of the run."""
    scratch = Scratch(log.sparkSession, "logged")
    numbered = group_ranks(log.withColumn("_all", F.lit(0)), "_all", ["entity_id"], scratch, rank="_rank")
    return numbered.select((F.col("_rank") + 1).alias("id"), *[c for c in log.columns if c != "entity_id"], resolved_at.cast("timestamp").alias("resolved_at"))


def save_mappings(log: DataFrame, path: str, resolved_at: Column | None = None, group_bytes: int = 8 << 20) -> int:
    """Replace the mapping log at path; an empty log leaves the old one. Returns the rows written.

    Rows are laid out by raw name, in ranges and in order, with a Bloom filter of the
    names in each row group, so that a lookup (``mapping_of``) reads the one group that holds its name.

    The new log is written beside the old one, which goes only when the new one
    is whole, so a failed run loses nothing. With resolved_at the log gets ids and that time.
    """
    if log.isEmpty():
        return 0
    spark = log.sparkSession
    ready = log if resolved_at is None else logged(log, resolved_at)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{x}-{uuid.uuid4().hex}") for x in ("new", "old"))  # noqa: SLF001
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = ready.repartitionByRange(count, "raw_name").sortWithinPartitions("raw_name")
    laid.write.option("parquet.bloom.filter.enabled#raw_name", "true").option("parquet.block.size", group_bytes).parquet(new.toString())
    if files.exists(where):
        files.rename(where, old)
    files.rename(new, where)
    if files.exists(old):
        files.delete(old, True)
    return spark.read.parquet(path).count()


def mapping_of(log: DataFrame, raw_name: str) -> DataFrame:
    """The rows of one raw name in a saved log. Files and row groups whose least and greatest name or Bloom filter rule it out are not read."""
    return log.where(F.col("raw_name") == raw_name)


def mappings_like(log: DataFrame, part: str) -> DataFrame:
    """(raw_name, canonical_name, match_method) of the names that hold a piece of text, whatever its case."""
    escaped = part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return log.where(F.col("raw_name").ilike(f"%{escaped}%")).select("raw_name", "canonical_name", "match_method")


def method_summary(log: DataFrame) -> DataFrame:
    """Rows and mean confidence (three places, half to even) of each method, the most frequent first."""
    return log.groupBy("match_method").agg(F.count("*").alias("n"), F.bround(F.avg("confidence"), 3).alias("avg_confidence")).orderBy(F.desc("n"), "match_method")


def compression(log: DataFrame) -> DataFrame:
    """One row: total names, distinct canonical names and the share saved."""
    total, distinct = F.count("*"), F.countDistinct("canonical_name")
    return log.agg(total.alias("total_raw"), distinct.alias("distinct_canonical")).withColumn(
        "compression_ratio", F.format_string("%.2f%%", (1 - F.col("distinct_canonical") / F.greatest("total_raw", F.lit(1))) * 100)
    )


def variant_clusters(log: DataFrame, most: int = 20) -> DataFrame:
    """The canonical names with most variants, ties by name, and their names in order.

    Names are counted first; only those of the winners are put in order, a listing
    being made of runs of names, each of which is joined by a task of its own.
    """
    counts = log.groupBy("canonical_name").agg(F.count("*").alias("variant_count")).where("variant_count > 1")
    scratch = Scratch(log.sparkSession, "variants")
    winners = scratch.keep(counts.orderBy(F.desc("variant_count"), "canonical_name").limit(most))
    rows = log.select("canonical_name", "raw_name").join(F.broadcast(winners.select("canonical_name")), "canonical_name", "left_semi")
    ranked = group_ranks(rows, "canonical_name", ["raw_name"], scratch, rank="_rank")
    runs = ranked.groupBy("canonical_name", F.floor(F.col("_rank") / RUN).alias("_run")).agg(F.expr("listagg(raw_name, ' | ') WITHIN GROUP (ORDER BY raw_name)").alias("_part"))
    listed = runs.groupBy("canonical_name").agg(F.expr("listagg(_part, ' | ') WITHIN GROUP (ORDER BY _run)").alias("variants"))
    return winners.join(listed, "canonical_name").select("canonical_name", "variant_count", "variants").orderBy(F.desc("variant_count"), "canonical_name")


def pair_count(index: DataFrame, frequent: int = FREQUENT_BLOCK, most_keys: int = 12) -> DataFrame:
    """One row, ``pairs``: how many pairs of entities share a block of the index (block_key, entity_id), without making those of large blocks.

    Pairs that share a frequent block (more members than that) are counted by
    inclusion and exclusion: a set S of frequent blocks that n entities have in
    common holds n(n-1)/2 pairs, which count for an odd S and against an even
    one. The other pairs share small blocks alone; they are joined, each met at the
    first block that it shares, so an entity meets a bounded number of others in
    each block. Blocks of one entity are left out, and entities with the same blocks
    are taken together. Work grows with the entities times two to the number of
    frequent blocks in each; entities with more than ``most_keys`` of them are
    joined with all others that share a block.
    """
    scratch = Scratch(index.sparkSession, "pair_count")
    shared = index.groupBy("block_key").agg(F.count("*").alias("n")).where("n > 1").select("block_key", (F.col("n") > frequent).alias("large"))

    def keys(large: bool) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("large") == large, F.col("block_key"))))

    sets = index.join(shared, "block_key").groupBy("entity_id").agg(keys(True).alias("hot"), keys(False).alias("cold"))
    sets = scratch.keep(sets.groupBy("hot", "cold").agg(F.count("*").cast("decimal(20,0)").alias("n")).withColumn("size", F.size("hot")))
    few, many = sets.where(F.col("size") <= most_keys), sets.where(F.col("size") > most_keys)

    def inside(n: Column) -> Column:
        return (n * (n - 1) / 2).cast("decimal(38,0)")

    chosen = few.groupBy("hot", "size").agg(F.sum("n").alias("n")).where("size > 0").withColumn("mask", F.explode(F.expr("sequence(1, shiftleft(1, size) - 1)")))
    subset = chosen.select("n", F.expr("filter(hot, (k, i) -> getbit(mask, i) = 1)").alias("s"))
    # 96 bits stand for a set of blocks
    counts = subset.groupBy(F.xxhash64("s").alias("h"), F.hash("s").alias("g")).agg(F.sum("n").alias("n"), F.max(F.size("s")).alias("of"))
    parts = counts.select(F.when(F.col("of") % 2 == 1, inside(F.col("n"))).otherwise(-inside(F.col("n"))).alias("pairs"))

    def met(left: DataFrame, right: DataFrame, column: str, also: Column) -> DataFrame:
        """The pairs of two different sets at the first element of the column that they share."""
        x, y = (rows.withColumn("key", F.explode(column)).alias(name) for rows, name in ((left, "x"), (right, "y")))
        first = F.get(F.array_intersect(f"x.{column}", f"y.{column}"), F.lit(0)) == F.col("x.key")
        return x.join(y, (F.col("x.key") == F.col("y.key")) & also & first).select((F.col("x.n") * F.col("y.n")).cast("decimal(38,0)").alias("pairs"))

    earlier = F.struct("x.hot", "x.cold") < F.struct("y.hot", "y.cold")
    parts = parts.unionByName(met(few, few, "cold", earlier & ~F.arrays_overlap("x.hot", "y.hot")))
    # entities with the same small blocks and no frequent one
    parts = parts.unionByName(few.where("size = 0").select(inside(F.col("n")).alias("pairs")))
    if not many.isEmpty():
        each = sets.withColumn("keys", F.concat("hot", "cold"))
        parts = parts.unionByName(met(each.where(F.col("size") > most_keys), each, "keys", (F.col("y.size") <= most_keys) | earlier)).unionByName(many.select(inside(F.col("n")).alias("pairs")))
    return parts.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("pairs"))


def pair_reduction(entities: DataFrame, max_prefix: int = MAX_PREFIX_BLOCK) -> DataFrame:
    """One row: entities, candidate pairs, and the share of all pairs that blocking leaves out. The pairs are counted, not made."""
    n = entities.agg(F.count("*").alias("entities"))
    pairs = pair_count(block_index(entities, max_prefix))
    total = F.greatest(F.col("entities") * (F.col("entities") - 1) / 2, F.lit(1.0))
    return n.join(F.broadcast(pairs)).select("entities", "pairs", (1 - F.col("pairs") / total).alias("reduction"))
