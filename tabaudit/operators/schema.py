"""Column names of ragged datasets: the schema table, rename plans, and their application to rows.

Rows of all datasets live in ``records(dataset_id, row_no, row MAP<STRING,STRING>)``, where they come from JSON with ``bare``, the
keys whose values aren't strings there. Renames depend on the whole
column list of a dataset, so they are planned on ``dataset_columns`` (one row per dataset and column) and joined
back by key list (:func:`layouts`), or as one map per dataset. No join is forced to broadcast: plans grow with the number of datasets, and adaptive
execution broadcasts them when their measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabaudit.functions.similarity import best_name
from tabaudit.functions.text import strip
from tabaudit.session import written

# Names that mean "year".
YEAR = "tahun"
YEAR_FALLBACKS = ["tahun_data", "tahundata", "tahun_pembuatan", "thn", "year"]
YEAR_PATTERNS = ["tahun", "tahun_data", "year", "thn", "tahun_pembuatan", "tahundata"]
YEAR_HINTS = ["tahun", "year"]
NO_YEAR_ISSUE = "Tidak ditemukan kolom tahun yang valid untuk distandarkan."

PLAN_COLUMNS = ["dataset_id", "ord", "old", "new", "method", "score"]


def layouts(records: DataFrame) -> DataFrame:
    """``(dataset_id, keys, first_row)``: the distinct key lists among the rows of each dataset, and the first row that has each.

    Most datasets have one. Counting them is a partial aggregate, so what is exchanged grows with the key lists, not with the rows.
    Rows without keys are dropped by their count: a filter on the keys would be moved below what makes the rows, which were made twice.
    """
    keyed = records.select("dataset_id", "row_no", F.map_keys("row").alias("keys"))
    found = keyed.groupBy("dataset_id", "keys").agg(F.min("row_no").alias("first_row"), F.count("keys").alias("_n"))
    return found.where("_n > 0").drop("_n")


def _first_seen(found: DataFrame) -> DataFrame:
    keys = found.select("dataset_id", "first_row", F.posexplode("keys").alias("pos", "col"))
    return keys.groupBy("dataset_id", "col").agg(F.min(F.struct("first_row", "pos")).alias("first"))


def columns_of(found: DataFrame) -> DataFrame:
    """``(dataset_id, col, ord)`` from the key lists of :func:`layouts`."""
    by_first = Window.partitionBy("dataset_id").orderBy("first")
    return _first_seen(found).select("dataset_id", "col", (F.row_number().over(by_first) - 1).alias("ord"))


def models_of(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Datasets with the same columns in the same order fare alike in a plan, so one of them, the model, is planned for all.

    Returns ``models(dataset_id, model)`` for all datasets and ``(dataset_id, col, ord)`` of the models, from the key lists of
    :func:`layouts`. The model is the least id. Rows without an id are a dataset that is its own model.
    """
    listed = F.array_sort(F.collect_list(F.struct("first", "col")))["col"]
    lists = written(_first_seen(found).groupBy("dataset_id").agg(listed.alias("cols")).withColumn("nameless", F.col("dataset_id").isNull()))
    kinds = written(lists.groupBy("cols", "nameless").agg(F.min("dataset_id").alias("model")), packed=False)
    columns = kinds.select(F.col("model").alias("dataset_id"), F.posexplode("cols").alias("ord", "col")).select("dataset_id", "col", "ord")
    return written(lists.join(kinds, ["cols", "nameless"]).select("dataset_id", "model"), packed=False), columns


def of_all(table: DataFrame, models: DataFrame) -> DataFrame:
    """A table on the model datasets of :func:`models_of`, repeated for every dataset that has the model."""
    return models.join(table.withColumnRenamed("dataset_id", "_model"), F.col("model").eqNullSafe(F.col("_model"))).select(*table.columns)


def dataset_columns(records: DataFrame) -> DataFrame:
    """``(dataset_id, col, ord)``: the union of keys of each dataset in first-seen order."""
    return columns_of(layouts(records))


def _plain(name: Column) -> Column:
    return F.lower(strip(name))


def audit_rename_plan(columns: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """New name of every column: explicit alias, year fallback, lower case; the first claimant of a name wins.

    An alias or year name that already exists in the dataset is never claimed. Returns ``dataset_id, ord, old,
    new, method, score``; ``method`` is NULL where the name stays.
    """
    alias = _lookup(aliases, _plain(F.col("col")))
    is_year = _plain(F.col("col")).isin(YEAR_FALLBACKS)
    claims = columns.select(
        "dataset_id",
        "ord",
        F.col("col").alias("old"),
        F.coalesce(alias, F.when(is_year, F.lit(YEAR)), _plain(F.col("col"))).alias("target"),
        F.when(alias.isNotNull(), "explicit_alias").when(is_year, "tahun_fallback").otherwise("lowercase").alias("rule"),
    )
    in_dataset_by_target = Window.partitionBy("dataset_id", "target")
    existing = columns.select("dataset_id", F.col("col").alias("target"), F.lit(True).alias("exists"))
    claims = claims.join(existing, ["dataset_id", "target"], "left").withColumn(
        "may_claim",
        (F.col("old") != F.col("target")) & ((F.col("rule") == "lowercase") | F.col("exists").isNull()),
    )
    winner = F.min(F.when(F.col("may_claim"), F.col("ord"))).over(in_dataset_by_target)
    wins = F.col("may_claim") & (F.col("ord") == winner)
    return claims.select(
        "dataset_id",
        "ord",
        "old",
        F.when(wins, F.col("target")).otherwise(F.col("old")).alias("new"),
        F.when(wins, F.col("rule")).alias("method"),
        F.when(wins, F.lit(100)).alias("score"),
    )


def year_column(columns: DataFrame) -> DataFrame:
    """``(dataset_id, year_col, method, has_year)``: the column that holds the year, NULL where there is none.

    Names from the fixed list come first, then names that merely contain a year word; ties go to column order.
    """
    squeezed = F.regexp_replace(_plain(F.col("col")), " ", "")
    contains = F.lit(False)
    for hint in YEAR_HINTS:
        contains = contains | F.contains(squeezed, F.lit(hint))
    rank = F.when(squeezed.isin(YEAR_PATTERNS), 0).when(contains, 1)
    best = F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), "ord", "col")))
    return (
        columns.groupBy("dataset_id")
        .agg(best.alias("best"), F.max(F.col("col") == YEAR).alias("has_year"))
        .select(
            "dataset_id",
            F.col("best.col").alias("year_col"),
            F.when(F.col("best.rank") == 0, "pattern").when(F.col("best.rank") == 1, "contains").alias("method"),
            "has_year",
        )
    )


def with_year_rename(plan: DataFrame) -> DataFrame:
    """Follow a rename plan by renaming the year column to ``tahun`` where no such column exists yet."""
    named = plan.select("dataset_id", F.col("new").alias("col"), "ord")
    years = year_column(named).where(~F.col("has_year")).select("dataset_id", "year_col", F.col("method").alias("year_method"))
    joined = plan.join(years, "dataset_id", "left")
    hit = F.coalesce(F.col("new") == F.col("year_col"), F.lit(False))
    return joined.select(
        "dataset_id",
        "ord",
        "old",
        F.when(hit, F.lit(YEAR)).otherwise(F.col("new")).alias("new"),
        F.when(hit, F.concat(F.lit("year_"), "year_method")).otherwise(F.col("method")).alias("method"),
        F.when(hit, F.lit(100)).otherwise(F.col("score")).alias("score"),
    )


def key_rename_plan(
    columns: DataFrame, aliases: dict[str, str], fuzzy_threshold: int = 80, target_columns: Sequence[str] = ()
) -> DataFrame:
    """New name of every key before delivery; the first rule that applies decides.

    Order: explicit alias, name already standard, best fuzzy match among the known columns, best fuzzy match among
    the alias targets, lower case. Every *distinct* name is scored once, whatever the number of datasets.
    """
    standard = sorted(set(aliases.values()))
    known = sorted(set(target_columns))
    plain = _plain(F.col("col"))
    names = columns.select(plain.alias("plain")).distinct()
    alias = _lookup(aliases, F.col("plain"))
    settled = alias.isNotNull() | F.col("plain").isin(standard) | F.col("plain").isin(known)
    names = names.withColumn("alias", alias).withColumn("settled", settled)
    fuzzy = names.where(~F.col("settled"))
    for label, targets in (("fuzzy_match", known), ("fuzzy_alias_target", standard)):
        found = best_name(F.col("plain"), targets) if targets else F.lit(None).cast("struct<match:string,score:int>")
        fuzzy = fuzzy.withColumn(label, found)
    passed = [F.col(f"{label}.score") >= fuzzy_threshold for label in ("fuzzy_match", "fuzzy_alias_target")]
    fuzzy = fuzzy.select(
        "plain",
        F.when(passed[0], F.col("fuzzy_match.match")).when(passed[1], F.col("fuzzy_alias_target.match")).alias("fuzzy"),
        F.when(passed[0], "fuzzy_match").when(passed[1], "fuzzy_alias_target").alias("fuzzy_method"),
        F.when(passed[0], F.col("fuzzy_match.score")).when(passed[1], F.col("fuzzy_alias_target.score")).alias("fuzzy_score"),
    )
    names = names.join(fuzzy, "plain", "left")
    planned = columns.withColumn("plain", plain).join(names, "plain", "left")
    new = F.coalesce("alias", "fuzzy", "plain")
    changes = F.col("col") != F.col("plain")
    method = (
        F.when(F.col("alias").isNotNull(), "explicit_alias")
        .when(F.col("fuzzy").isNotNull(), F.col("fuzzy_method"))
        .when(changes & F.col("settled"), "case_normalize")
        .when(changes, "lowercase_fallback")
    )
    score = F.when(F.col("fuzzy").isNotNull(), F.col("fuzzy_score")).when(method == "lowercase_fallback", 0).otherwise(100)
    return planned.select(
        "dataset_id", "ord", F.col("col").alias("old"), new.alias("new"), method.alias("method"), F.when(method.isNotNull(), score).alias("score")
    )


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    """Configuration lookup as an expression (the alias list is a small, fixed file)."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.element_at(F.create_map(*pairs), key)


def settle_duplicates(plan: DataFrame, keep: str = "first") -> DataFrame:
    """Mark all but one of the columns that end up with the same name; ``keep`` is ``first`` or ``last``."""
    same_name = Window.partitionBy("dataset_id", "new")
    kept = (F.min if keep == "first" else F.max)("ord").over(same_name)
    return plan.withColumn("dropped", F.col("ord") != kept)


def rename_report(plan: DataFrame) -> DataFrame:
    """The columns whose name changed, with the rule that changed them."""
    return plan.where(F.col("method").isNotNull()).select(
        "dataset_id",
        F.col("old").alias("old_column"),
        F.col("new").alias("new_column"),
        F.col("method").alias("match_method"),
        F.col("score").alias("match_score"),
    )


def layout_changes(
    found: DataFrame, plan: DataFrame, required: Sequence[str] = (), models: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """What the plan does to the rows of a key list, in two written tables: ``(keys, moves, present)`` for the key lists that fare alike in
    every dataset, and the same with ``dataset_id`` for the others.

    ``moves`` lists the keys that change, with ``stays`` false for those that are dropped; ``present`` lists the required columns
    that the dataset has after the plan, whether this row has them or not. With ``models`` the plan is one on the models
    of :func:`models_of`, and what it does is worked out once for each of their key lists.
    """
    if models is not None:
        own = found.join(models.hint("merge"), "dataset_id")  # both grow with the datasets, and compressed files look small
        found = written(own.select(F.col("model").alias("dataset_id"), "keys").distinct(), packed=False)
    changes = (F.col("old") != F.col("new")) | F.col("dropped")
    per_dataset = plan.groupBy("dataset_id").agg(
        F.map_from_entries(F.collect_list(F.when(changes, F.struct("old", F.struct("new", (~F.col("dropped")).alias("stays")))))).alias("renames"),
        F.array_sort(F.collect_set(F.when(~F.col("dropped") & F.col("new").isin(list(required)), F.col("new")))).alias("present"),
    )
    moves = F.transform(
        F.filter("keys", lambda k: F.map_contains_key("renames", k)),
        lambda k: F.struct(k.alias("old"), F.col("renames")[k]["new"].alias("new"), F.col("renames")[k]["stays"].alias("stays")),
    )
    lines = found.join(per_dataset, "dataset_id").select("dataset_id", "keys", F.struct(moves.alias("moves"), "present").alias("fate"))
    alike = written(lines.groupBy("keys").agg(F.min("fate").alias("fate"), (F.min("fate") == F.max("fate")).alias("alike")), packed=False)
    apart = lines.join(alike.where("NOT alike").select("keys"), "keys", "left_semi").select("dataset_id", "keys", "fate.*")
    if models is not None:
        apart = written(apart, packed=False)
        if not apart.isEmpty():
            apart = own.select("dataset_id", "model", "keys").join(apart.withColumnRenamed("dataset_id", "model"), ["model", "keys"]).drop("model")
    return alike.where("alike").select("keys", "fate.*"), written(apart, packed=False)


def _by_key_list(table: DataFrame) -> DataFrame:
    """What the rows of a key list need, worked out once for all of them: ``renames`` (key to new name, NULL where dropped), the ``names``
    that are left, and their ``places`` among the keys, NULL where none is dropped. All are NULL where nothing changes."""
    entries = F.transform("moves", lambda m: F.struct(m["old"], F.when(m["stays"], m["new"])))
    table = table.withColumn("renames", F.when(F.size("moves") > 0, F.map_from_entries(entries))).drop("moves")
    target = F.transform("keys", lambda k, i: F.struct(F.when(F.map_contains_key("renames", k), F.col("renames")[k]).otherwise(k).alias("name"), (i + 1).alias("place")))
    table = table.withColumn("left", F.when(F.col("renames").isNotNull(), F.filter(target, lambda t: t["name"].isNotNull())))
    places = F.when(F.size("left") < F.size("keys"), F.col("left")["place"])
    return table.withColumns({"names": F.col("left")["name"], "places": places}).drop("left")


def apply_plan(
    records: DataFrame, plan: DataFrame, found: DataFrame | None = None, required: Sequence[str] | None = None, models: DataFrame | None = None
) -> DataFrame:
    """Rename the keys of every row. Needs the ``dropped`` mark of :func:`settle_duplicates`.

    With ``found``, the :func:`layouts` of these records, rows meet the plan by their key list: a table as large as the
    number of key lists, whatever the number of datasets. Only key lists that fare differently in several datasets are met
    by dataset as well. Without it, the columns that change are joined by dataset; rows of datasets without changes pass through.
    With ``required`` rows get ``present``, the required columns that their dataset has, for :func:`tabaudit.operators.rules.flag_missing`.
    With ``models`` the plan is one on the models of :func:`models_of`.
    """
    if found is None:
        if required is not None or models is not None:
            raise ValueError("required columns and models need the layouts")
        changes = (
            plan.where((F.col("old") != F.col("new")) | F.col("dropped"))
            .groupBy("dataset_id")
            .agg(
                F.map_from_entries(F.collect_list(F.struct("old", F.when(~F.col("dropped"), F.col("new"))))).alias("renames")
            )
        )
        joined, extra = records.join(changes, "dataset_id", "left"), []
    else:
        alike, apart = layout_changes(found, plan, required or (), models)
        fates = ["present", "renames", "names", "places"]
        joined = records.withColumn("_keys", F.map_keys("row")).join(_by_key_list(alike).withColumnRenamed("keys", "_keys"), "_keys", "left")
        if not apart.isEmpty():
            own = _by_key_list(apart).select("dataset_id", F.col("keys").alias("_keys"), *[F.col(name).alias(f"_{name}") for name in fates])
            joined = joined.join(own, ["dataset_id", "_keys"], "left").withColumns({name: F.coalesce(f"_{name}", name) for name in fates})
        extra = [] if required is None else [F.coalesce("present", F.array().cast("array<string>")).alias("present")]
    untouched = F.col("renames").isNull()
    if found is None:
        kept = F.map_filter("row", lambda k, v: ~F.map_contains_key("renames", k) | F.col("renames")[k].isNotNull())
        renamed = F.transform_keys(kept, lambda k, v: F.coalesce(F.col("renames")[k], k))
    else:
        values = F.map_values("row")
        chosen = F.when(F.col("places").isNull(), values).otherwise(F.transform("places", lambda place: F.element_at(values, place)))
        renamed = F.map_from_arrays("names", chosen)
    joined = joined.withColumn("row", F.when(untouched, F.col("row")).otherwise(renamed))
    if "bare" in records.columns:
        stays = F.filter("bare", lambda k: ~F.map_contains_key("renames", k) | F.col("renames")[k].isNotNull())
        joined = joined.withColumn("bare", F.when(untouched, F.col("bare")).otherwise(F.transform(stays, lambda k: F.coalesce(F.col("renames")[k], k))))
    return joined.select(*records.columns, *extra)


def final_columns(plan: DataFrame) -> DataFrame:
    """``(dataset_id, col, ord)`` after the plan."""
    return plan.where(~F.col("dropped")).select("dataset_id", F.col("new").alias("col"), "ord")


def schema_issues(columns: DataFrame, required: Sequence[str], plan: DataFrame | None = None) -> DataFrame:
    """``(dataset_id, Schema_Issues)``: no year column, required columns absent, columns dropped as duplicates."""
    squeezed = F.regexp_replace(_plain(F.col("col")), " ", "")
    is_year = squeezed.isin(YEAR_PATTERNS)
    for hint in YEAR_HINTS:
        is_year = is_year | F.contains(squeezed, F.lit(hint))
    flags = [F.max(is_year).alias("has_year")] + [
        F.max(F.col("col") == name).alias(f"has_{i}") for i, name in enumerate(required)
    ]
    found = columns.groupBy("dataset_id").agg(*flags)
    absent = [F.when(~F.col(f"has_{i}"), F.lit(f"'{name}'")) for i, name in enumerate(required)]
    listed = F.concat_ws(", ", *absent) if absent else F.lit("")
    issues = [
        F.when(~F.col("has_year"), F.lit(NO_YEAR_ISSUE)),
        F.when(listed != "", F.concat(F.lit("Missing required columns: ["), listed, F.lit("]"))),
    ]
    if plan is not None:
        dropped = (
            plan.where("dropped")
            .groupBy("dataset_id")
            .agg(F.array_join(F.array_sort(F.collect_set(F.concat(F.lit("'"), "new", F.lit("'")))), ", ").alias("dups"))
        )
        found = found.join(dropped, "dataset_id", "left")
        issues.append(F.concat(F.lit("Duplicate columns dropped: ["), F.col("dups"), F.lit("]")))
    return found.select("dataset_id", F.concat_ws(" | ", *issues).alias("Schema_Issues"))
