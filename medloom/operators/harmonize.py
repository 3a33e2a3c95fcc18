"""Re-coding rows to the target vocabulary.

The steps run in a fixed order and the first that applies to a row's key
settles it. Whether a step applies, and what it gives, depends only on the
row's two concept ids. A vocabulary that may be broadcast is looked up from
the rows themselves, in a single pass without a shuffle. A larger one is
looked up from the distinct pairs of ids in use, once for all steps, and the
rows are joined with what their pair comes to. Where one step or one table is
asked for, rows that cannot come to it are sieved out before they shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import schema
from medloom.operators.joins import counted_keys, fits, lookup_join, passes, salted_join, sieve
from medloom.operators.vocabulary import Vocabulary
from medloom.sources.storage import materialize

SOURCE_TARGET = "source_target"
TARGET_REMAP = "target_remap"
TARGET_REPLACEMENT = "target_replacement"
SOURCE_BACKFILL = "source_concept_backfill"
DOMAIN_CHECK = "domain_check"
STEPS = [SOURCE_TARGET, TARGET_REMAP, TARGET_REPLACEMENT, SOURCE_BACKFILL, DOMAIN_CHECK]
DEFAULT_STEPS = [SOURCE_TARGET, TARGET_REMAP, SOURCE_BACKFILL, DOMAIN_CHECK]

STATUS = {
    SOURCE_TARGET: "source_concept_id mapped to new target",
    TARGET_REMAP: "existing non-standard target remapped to standard code",
    TARGET_REPLACEMENT: "existing non-standard target replaced with standard code",
    SOURCE_BACKFILL: "source_concept_id backfill",
    DOMAIN_CHECK: "domain check",
}


def table_for(domain: Column, own_table: str) -> Column:
    """Table a concept of this domain belongs to; its own table if unclear."""
    routes = F.create_map(*[F.lit(x) for pair in schema.DOMAIN_TABLE.items() for x in pair])
    return F.coalesce(routes[F.coalesce(domain, F.lit(""))], F.lit(own_table))


def harmonize(
    df: DataFrame,
    table: str,
    vocabulary: Vocabulary,
    steps: list[str] | None = None,
    concept: str | None = None,
    source: str | None = None,
    repeated_key: str | None = None,
    only_step: str | None = None,
    only_table: str | None = None,
) -> DataFrame:
    """Rows re-coded by the given steps, with the reason and the new table.

    A source with several targets yields several rows. Rows no step settles
    are left out (none are while the domain check is among the steps).
    ``repeated_key`` names a delivered key that several different rows may
    share; the first step that settles any of them then decides for all.
    Tables whose key derives from content do not need it.

    ``only_step`` and ``only_table`` give the rows settled by one step or led
    to one table, as a filter of the result would, but leave the others out
    as early as their ids tell.
    """
    concept = concept or schema.PRIMARY_CONCEPT[table]
    source = source or schema.primary_pair(table)[1]
    wanted = DEFAULT_STEPS if steps is None else steps
    unknown = [s for s in [*wanted, *([only_step] if only_step else [])] if s not in STEPS]
    if unknown:
        raise ValueError(f"unknown harmonization step {', '.join(unknown)}")
    chosen = [s for s in STEPS if s in wanted]
    if source is None:
        chosen = [s for s in chosen if s not in (SOURCE_TARGET, SOURCE_BACKFILL)]

    if only_step and not repeated_key and only_step in chosen[:1]:
        # What the first step settles does not depend on those after it.
        chosen = chosen[:1]

    ids = {"_target": F.col(concept), "_source": F.col(source) if source else F.lit(0).cast("bigint")}

    def settled(rows: DataFrame) -> DataFrame:
        rows = _with_steps(rows, chosen)
        if repeated_key:
            rows = _settle_by_key(rows, repeated_key, chosen)
        return _with_outcomes(rows, table, chosen, only_step, only_table)

    if only_step and not repeated_key:
        df = df.filter(_possible(only_step, ids["_source"], ids["_target"]))
    if fits(vocabulary.concept) and fits(vocabulary.mapping):
        rows = settled(_with_profiles(df.withColumns(ids), vocabulary))
    elif repeated_key:
        rows = settled(_looked_up(df.withColumns(ids), vocabulary))
    else:
        lead = _leading(vocabulary, ids["_source"], ids["_target"], table, only_step, only_table)
        rows = _with_sources(df.filter(lead).withColumns(ids), vocabulary) if chosen == [SOURCE_TARGET] else None
        if rows is not None:
            rows = settled(rows)
        else:
            rows = _settled_by_pairs(df, ids, vocabulary, settled, lead, bool(only_step or only_table)).withColumns(ids)

    recoded_from_target = _at(chosen, TARGET_REMAP, TARGET_REPLACEMENT)
    rows = rows.withColumn("_outcome", F.explode("_outcomes"))
    code = F.col("_outcome.code")
    replaced = {concept: code}
    if source:
        replaced[source] = F.when(recoded_from_target, F.col("_target")).otherwise(F.col("_source"))
    status = F.array(*[F.lit(STATUS[s]) for s in chosen])[F.col("_step")]
    return rows.select(
        *[replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns],
        F.col("_outcome.domain").alias("target_domain"),
        status.alias("vocab_harmonization_status"),
        F.col("_source").alias("source_concept_id"),
        F.col("_target").alias("previous_target_concept_id"),
        code.alias("target_concept_id"),
        F.col("_outcome.relation").alias("mapping_relationship_id"),
        F.col("_value").cast("bigint").alias("vh_value_as_concept_id"),
        F.col("_outcome.table").alias("target_table"),
    )


def _at(chosen: list[str], *names: str) -> Column:
    """Whether one of the named steps settled a row."""
    return F.col("_step").isin([chosen.index(n) for n in names if n in chosen])


def _with_steps(rows: DataFrame, chosen: list[str]) -> DataFrame:
    applies = _applicable(chosen)
    rows = rows.withColumns({f"_is_{s}": applies[s] for s in chosen})
    return rows.withColumn("_step", F.coalesce(*[F.when(F.col(f"_is_{s}"), F.lit(i)) for i, s in enumerate(chosen)]))


def _with_outcomes(
    rows: DataFrame, table: str, chosen: list[str], only_step: str | None = None, only_table: str | None = None,
) -> DataFrame:
    """Attach what the row's step makes of it (_outcomes, _value); rows that come to nothing go."""
    rows = rows.filter(F.col("_step").isNotNull())
    if only_step:
        rows = rows.filter(_at(chosen, only_step))
    recoded_from_target, backfilled = _at(chosen, TARGET_REMAP, TARGET_REPLACEMENT), _at(chosen, SOURCE_BACKFILL)
    recoded = _at(chosen, SOURCE_TARGET) | recoded_from_target
    found = (
        F.when(_at(chosen, SOURCE_TARGET), F.col("_s_map")).when(_at(chosen, TARGET_REMAP), F.col("_t_map"))
        .when(_at(chosen, TARGET_REPLACEMENT), F.col("_t_replace"))
    )
    kind = rows.schema["_t_map"].dataType
    others = F.filter(F.coalesce(found, F.array().cast(kind)), lambda x: x["new"] != F.col("_target"))

    def outcome(code: Column, domain: Column, relation: Column) -> Column:
        return F.struct(
            code.alias("code"), domain.alias("domain"), relation.alias("relation"), table_for(domain, table).alias("table"))

    own_domain = F.when(backfilled, F.col("_s_domain")).when(F.col("_t_known"), F.col("_t_domain"))
    itself = outcome(
        F.when(backfilled, F.col("_source")).otherwise(F.col("_target")), F.coalesce(own_domain, F.lit("Unknown")),
        F.lit(None).cast(kind.elementType["relation"].dataType))
    outcomes = F.when(recoded, F.transform(others, lambda x: outcome(x["new"], x["domain"], x["relation"]))).otherwise(F.array(itself))
    if only_table:
        outcomes = F.filter(outcomes, lambda x: x["table"] == only_table)
    value = F.when(_at(chosen, SOURCE_TARGET), F.col("_s_value")).when(recoded_from_target, F.col("_t_value"))
    return rows.withColumns({"_outcomes": outcomes, "_value": value}).filter(F.size("_outcomes") > 0)


def _possible(step: str, source: Column, target: Column) -> Column:
    """What the ids alone must meet for a step to settle a row."""
    if step == SOURCE_BACKFILL:
        return (target == 0) & (source != 0)
    if step == SOURCE_TARGET:
        return target.isNotNull() & (source != 0)
    return F.lit(True) if step == DOMAIN_CHECK else target.isNotNull()


def _leading(
    vocabulary: Vocabulary, source: Column, target: Column, table: str, only_step: str | None, only_table: str | None,
) -> Column:
    """What sieves of concepts let pass of all ids, and surely of those that may come to the step or the table asked for.

    A table that rows of unknown domain stay in is led to by ids that no
    vocabulary has, and so are the last two steps; these have no sieve.
    """
    own = F.col("concept_id")
    profiles = vocabulary.profiles

    def another(kind: str) -> Column:
        return (F.col(f"{kind}_low") != own) | (F.col(f"{kind}_high") != own)

    def sieve_of(rows: DataFrame, *columns: Column) -> DataFrame:
        return sieve(materialize(rows.select(F.xxhash64(*columns).alias("_hash")), "leading-concepts"))

    found = F.lit(True)
    if only_step in (TARGET_REMAP, TARGET_REPLACEMENT):
        recoded = profiles.filter(another("map" if only_step == TARGET_REMAP else "replace"))
        found &= passes(sieve_of(recoded, own), F.xxhash64(target))
    elif only_step == SOURCE_TARGET:
        # A source that has no target but itself re-codes no row that has it as a target already.
        same = F.explode(F.when(another("map"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
        recoded = profiles.filter("map_low IS NOT NULL").select("concept_id", same.alias("same"))
        found &= passes(sieve_of(recoded, own, F.col("same")), F.xxhash64(source, F.coalesce(source == target, F.lit(False))))
    if only_table and only_table != table:
        def leads(domain: Column) -> Column:
            return table_for(domain, table) == only_table
        some = [F.exists(kind, lambda x: leads(x["domain"])) for kind in ("map", "replace")]
        led = profiles.filter(leads(F.col("domain")) | some[0] | some[1])
        leading = sieve_of(led, own)
        found &= passes(leading, F.xxhash64(source)) | passes(leading, F.xxhash64(target))
    return found


# Stands for a missing id where pairs of ids are joined.
_NO_ID = -(2**63)
_PAIR = ["_pair_s", "_pair_t"]


def _pair_of(source: Column, target: Column) -> dict[str, Column]:
    return {name: F.coalesce(c, F.lit(_NO_ID)) for name, c in zip(_PAIR, (source, target))}


def _counted_pairs(rows: DataFrame) -> DataFrame:
    """The distinct pairs of rows (_source, _target, ...) and how many rows each has.

    Pairs are combined before they shuffle. They are counted, so that the heavy
    ones are known without a third look at the rows.
    """
    counted = rows.groupBy("_source", "_target").agg(F.count(F.lit(1)).alias("_pair_rows"))
    return materialize(counted.withColumns(_pair_of(F.col("_source"), F.col("_target"))), "concept-pairs")


def _looked_up(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (_source, _target, ...) with all that a vocabulary too large to broadcast says of the two.

    The rows are read once for their pairs and once for the result.
    """
    known = materialize(_with_profiles(_counted_pairs(rows), vocabulary).drop("_source", "_target"), "known-pairs")
    keyed = rows.withColumns(_pair_of(F.col("_source"), F.col("_target")))
    return lookup_join(keyed, known, _PAIR, narrow=False, number="_pair_rows").drop(*_PAIR)


def _settled_by_pairs(
    df: DataFrame, ids: dict[str, Column], vocabulary: Vocabulary, settled: Callable[[DataFrame], DataFrame],
    lead: Column, some: bool,
) -> DataFrame:
    """Rows with what their pair of ids comes to.

    What a row comes to is decided once for its pair, so the rows meet only
    that, and only the pairs that come to something. Ids are not repeated
    beside the rows' own columns, which shuffle if the pairs are many.

    Only rows that ``lead`` lets pass are looked at for their pairs. With
    ``some`` not all pairs come to something, and the rows are sieved by these.
    """
    pairs = _counted_pairs(df.filter(lead).select(*[c.alias(n) for n, c in ids.items()]))
    known = settled(_with_profiles(pairs, vocabulary))
    lookup = materialize(known.select(*_PAIR, "_step", "_outcomes", "_value"), "settled-pairs")
    pair = _pair_of(ids["_source"], ids["_target"])
    if some:
        df = df.filter(passes(sieve(lookup.select(F.xxhash64(*_PAIR))), F.xxhash64(*pair.values())))
    if fits(lookup):
        lookup, heavy = F.broadcast(lookup), {}
    else:
        heavy = counted_keys(pairs, _PAIR, "_pair_rows")
    if heavy:
        return salted_join(df.withColumns(pair), lookup, _PAIR, "inner", heavy).drop(*_PAIR)
    same = [pair[name] == F.col(name) for name in _PAIR]
    return df.join(lookup, same[0] & same[1], "inner").drop(*_PAIR)


def _profiles_of(vocabulary: Vocabulary, prefix: str, key: str) -> DataFrame:
    profiles = vocabulary.profiles.withColumn("known", F.lit(True))
    renamed = [F.col(c).alias(f"_{prefix}_{c.replace('_target', '')}") for c in profiles.columns[1:]]
    return profiles.select(F.col("concept_id").alias(key), *renamed)


def _with_profiles(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Attach what the vocabulary knows of the source and the target concept.

    Both joins take the same columns, so that Spark builds the lookup once.
    Profiles are wide, and rows that meet too many of them to broadcast are
    distinct pairs of ids: these shuffle, rather than that the profiles in use
    go through the driver.
    """
    rows = lookup_join(rows, _profiles_of(vocabulary, "s", "_source"), "_source", bound=vocabulary.concept, narrow=False)
    return lookup_join(rows, _profiles_of(vocabulary, "t", "_target"), "_target", bound=vocabulary.concept, narrow=False)


def _with_sources(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame | None:
    """Rows whose source concept has targets, with what is known of it, and nothing of the target concept.

    None where there are too many such concepts to broadcast, or where a
    concept has several profiles, which multiply the rows by either id.
    """
    profiles = _profiles_of(vocabulary, "s", "_source")
    recoding = materialize(profiles.filter("_s_map_low IS NOT NULL"), "recoding-sources")
    if not fits(recoding) or not profiles.groupBy("_source").count().filter("count > 1").isEmpty():
        return None
    unknown = {f"_t_{f.name[3:]}": F.lit(None).cast(f.dataType) for f in recoding.schema if f.name != "_source"}
    return rows.join(F.broadcast(recoding), "_source").withColumns(unknown)


def _applicable(steps: list[str]) -> dict[str, Column]:
    """For each step, whether it would change or settle a row on its own."""

    def another(low: str, high: str) -> Column:
        # Some target differs from the present one.
        return (F.col(low) != F.col("_target")) | (F.col(high) != F.col("_target"))

    tests = {
        SOURCE_TARGET: (F.col("_source") != 0) & another("_s_map_low", "_s_map_high"),
        TARGET_REMAP: another("_t_map_low", "_t_map_high"),
        TARGET_REPLACEMENT: another("_t_replace_low", "_t_replace_high"),
        SOURCE_BACKFILL: (F.col("_target") == 0) & (F.col("_source") != 0) & F.col("_s_known"),
        DOMAIN_CHECK: F.lit(True),
    }
    return {s: F.coalesce(tests[s], F.lit(False)) for s in steps}


def _settle_by_key(rows: DataFrame, key: str, steps: list[str]) -> DataFrame:
    """Let rows that share a key be settled together.

    Only keys that repeat are aggregated and joined back; most tables have few.
    """
    shared = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_step").alias("_first"),
        F.max("_s_value").alias("_key_s_value"), F.max("_t_value").alias("_key_t_value"),
    ).filter("_rows > 1")
    # Written, as it is both counted and joined.
    joined = lookup_join(rows, materialize(shared, "shared-keys"), key, narrow=False, number="_rows")
    is_shared = F.col("_first").isNotNull()
    applies = F.array(*[F.col(f"_is_{s}") for s in steps])[F.col("_first")]
    return joined.withColumns({
        "_step": F.when(is_shared, F.when(applies, F.col("_first"))).otherwise(F.col("_step")),
        "_s_value": F.when(is_shared, F.col("_key_s_value")).otherwise(F.col("_s_value")),
        "_t_value": F.when(is_shared, F.col("_key_t_value")).otherwise(F.col("_t_value")),
    })


def exclude_settled(df: DataFrame, settled: DataFrame, key: str) -> DataFrame:
    """Rows whose key no earlier output holds."""
    keys = materialize(settled.filter(F.col(key).isNotNull()).select(key).distinct(), "settled-keys")
    return lookup_join(df, keys, key, "left_anti", narrow=False)


def backfill_secondary(df: DataFrame, pairs: list[tuple[str, str]], vocabulary: Vocabulary) -> DataFrame:
    """Fill zero concepts of further pairs from their known source concept."""
    if not pairs:
        return df
    known = vocabulary.concept.select(F.col("concept_id").alias("_id")).distinct()

    def filled(found: dict[str, Column]) -> list[Column]:
        fills = {c: F.when((F.col(c) == 0) & (F.col(s) != 0) & found[s], F.col(s)).otherwise(F.col(c)).alias(c) for c, s in pairs}
        return [fills.get(c, F.col(c)) for c in df.columns]

    sources = sorted({s for _, s in pairs})
    if fits(known, vocabulary.concept):
        # Every pair looks into the same broadcast table, in one pass over the rows.
        tagged = df
        for i, source in enumerate(sources):
            named = known.select(F.col("_id").alias(f"_id{i}"), F.lit(True).alias(f"_known{i}"))
            tagged = tagged.join(F.broadcast(named), F.col(source) == F.col(f"_id{i}"), "left")
        return tagged.select(*filled({s: F.col(f"_known{i}") for i, s in enumerate(sources)}))
    # The sets of ids in use are few beside the rows: they meet the vocabulary, and the rows meet them once.
    group = [F.coalesce(F.col(s), F.lit(_NO_ID)).alias(f"_id{i}") for i, s in enumerate(sources)]
    sets = materialize(df.select(*group).distinct(), "id-sets")
    used = sets.select(F.explode(F.array(*[F.col(f"_id{i}") for i in range(len(sources))])).alias("_id")).distinct()
    used = materialize(used.join(known, "_id", "left_semi"), "known-ids")
    for i in range(len(sources)):
        named = used.select(F.col("_id").alias(f"_id{i}"), F.lit(True).alias(f"_known{i}"))
        sets = lookup_join(sets, named, f"_id{i}", narrow=False)
    sets = materialize(sets, "known-sets")
    keyed = df.withColumns({f"_id{i}": column for i, column in enumerate(group)})
    joined = lookup_join(keyed, sets, [f"_id{i}" for i in range(len(sources))], narrow=False)
    return joined.select(*filled({s: F.col(f"_known{i}") for i, s in enumerate(sources)}))


def secondary_backfill_counts(df: DataFrame, pairs: list[tuple[str, str]], vocabulary: Vocabulary) -> DataFrame:
    """Rows each further pair would fill, counted per concept before the lookup."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("concept_column"), F.col(c).alias("concept"), F.col(s).alias("_id")) for c, s in pairs
    ])
    candidates = (
        df.select(F.explode(entries).alias("e")).select("e.*")
        .groupBy("concept_column", "_id").agg(F.sum(F.when(F.col("concept") == 0, 1).otherwise(0)).alias("n"))
    )
    known = vocabulary.concept.select(F.col("concept_id").alias("_id")).distinct().withColumn("_known", F.lit(True))
    fills = (F.col("_id") != 0) & F.col("_known")
    return candidates.join(known, "_id", "left").groupBy("concept_column").agg(
        F.sum(F.when(fills, F.col("n")).otherwise(0)).alias("row_count")
    )


# ---- what happened to the rows -------------------------------------------------


def transitions(harmonized: DataFrame) -> DataFrame:
    return harmonized.groupBy("target_table").agg(F.count(F.lit(1)).alias("row_count"))


def target_tables(harmonized: DataFrame) -> DataFrame:
    return harmonized.select("target_table").distinct()


def status_counts(harmonized: DataFrame) -> DataFrame:
    return harmonized.groupBy("vocab_harmonization_status").agg(F.count(F.lit(1)).alias("row_count"))


def mapping_cardinality(harmonized: DataFrame, table: str, key: str) -> DataFrame:
    """Rows by the number of different targets their key has within its own table."""
    # Targets first, then keys: both levels combine before their shuffle.
    per_target = (
        harmonized.filter(F.col("target_table") == table)
        .groupBy(key, "target_concept_id").agg(F.count(F.lit(1)).alias("n"))
    )
    per_key = per_target.groupBy(key).agg(
        F.count("target_concept_id").alias("num_same_table_targets"), F.sum("n").alias("n")
    )
    return per_key.groupBy("num_same_table_targets").agg(F.sum("n").alias("num_source_rows"))


def row_disposition(harmonized: DataFrame, table: str, key: str) -> DataFrame:
    """Keys that stayed, stayed with copies elsewhere, or moved."""
    same = F.max(F.col("target_table") == table)
    cross = F.max(F.col("target_table") != table)
    per_key = harmonized.groupBy(key).agg(same.alias("same"), cross.alias("cross"))
    disposition = (
        F.when(F.col("same") & ~F.col("cross"), "stayed only")
        .when(F.col("same") & F.col("cross"), "stayed and copied")
        .otherwise("moved to other tables")
    )
    return per_key.groupBy(disposition.alias("disposition")).agg(F.count(F.lit(1)).alias("row_count"))


# What the report says of the rows of a harmonized table, by the operator that counts it alone.
TRANSITION, STATUS_COUNT, CARDINALITY, DISPOSITION = "transition", "status", "cardinality", "disposition"


def summary(harmonized: DataFrame, table: str, key: str) -> DataFrame:
    """(kind, label, row_count): transitions, statuses, cardinalities and dispositions from one pass over the rows.

    Rows are combined by key, table and target, then by key, then by what the
    report tells apart, of which there are few; each step combines before its
    shuffle, so a hot key or target costs no more than a rare one.
    """
    tables, statuses = schema.HARMONIZED_TABLES, list(STATUS.values())
    to = {f"_to{i}": F.when(F.col("target_table") == t, 1).otherwise(0) for i, t in enumerate(tables)}
    by = {f"_by{i}": F.when(F.col("vocab_harmonization_status") == s, 1).otherwise(0) for i, s in enumerate(statuses)}
    numbers = [*to, *by]
    own = F.col("target_table") == table
    targets = harmonized.groupBy(F.col(key).alias("_key"), "target_table", "target_concept_id").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(x).alias(n) for n, x in (to | by).items()])
    keys = targets.groupBy("_key").agg(
        F.max(own).alias("_same"), F.max(~own).alias("_cross"), F.count(F.when(own, F.col("target_concept_id"))).alias("_targets"),
        F.sum(F.when(own, F.col("_n"))).alias("_own"), *[F.sum(n).alias(n) for n in numbers])
    few = keys.groupBy("_same", "_cross", "_targets").agg(
        F.count(F.lit(1)).alias("_keys"), F.sum("_own").alias("_own"), *[F.sum(n).alias(n) for n in numbers])
    disposition = (
        F.when(F.col("_same") & ~F.col("_cross"), "stayed only").when(F.col("_same") & F.col("_cross"), "stayed and copied")
        .otherwise("moved to other tables"))

    def entry(kind: str, label: Column, number: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), label.cast("string").alias("label"), number.cast("bigint").alias("n"))

    entries = [
        *[entry(TRANSITION, F.lit(t), F.col(n)) for n, t in zip(to, tables)],
        *[entry(STATUS_COUNT, F.lit(s), F.col(n)) for n, s in zip(by, statuses)],
        entry(CARDINALITY, F.col("_targets"), F.col("_own")), entry(DISPOSITION, disposition, F.col("_keys"))]
    told = few.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter("n > 0")
    return told.groupBy("kind", "label").agg(F.sum("n").alias("row_count"))
