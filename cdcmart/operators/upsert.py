"""Keyed upsert as a pure function of two tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.times import micros_lit
from cdcmart.session import fresh_dir

_HIT = "__hit"
FILE = "__file"
ROW = "__row"
# Most files that are named in a filter.
LISTED_FILES = 2_000
_N = "__rows"


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _guard(source: DataFrame, keys: Sequence[str], allow_null_keys: bool) -> DataFrame:
    """No rows, in the columns of ``source``; evaluating it fails if the source breaks a precondition of the merge.

    Counted with partial sums, so a key that occurs very often is found as cheaply as one that occurs twice. It is a
    branch of its own because a check inside the source would stand between the source's shuffle and the join, and
    there adaptive execution no longer splits hot keys.
    """
    rows = F.col(_N)
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    tail = F.concat(shown, F.lit(" ("), rows.cast("string"), F.lit(" rows)"))
    twice = F.raise_error(F.concat(F.lit("source has several rows for key: "), tail)).cast("boolean")
    null_key = F.raise_error(F.concat(F.lit("source has a NULL key: "), tail)).cast("boolean")
    # A count is never negative, but the optimizer does not know; a literal would let it take the condition apart.
    nothing = rows < 0
    broken = F.when(_any_null(keys), nothing if allow_null_keys else null_key).when(rows > 1, twice).otherwise(nothing)
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N)).where(broken)
    return counted.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema])


def _updates(cols: Sequence[str], updated: set[str], newer_by: str | None) -> list[Column]:
    """``cols`` of target rows joined with their source rows, where there is one."""
    take = F.coalesce(F.col(_HIT), F.lit(False))
    if newer_by is not None:
        take = take & F.coalesce(F.col(f"__s_{newer_by}") >= F.col(newer_by), F.col(newer_by).isNull())
    return [F.when(take, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c) for c in cols]


def _updated_columns(cols: Sequence[str], keys: Sequence[str], update_cols: Sequence[str] | None) -> set[str]:
    updated = {c for c in cols if c not in keys} if update_cols is None else set(update_cols)
    unknown = updated - set(cols)
    if unknown:
        raise ValueError(f"update columns not in the target: {sorted(unknown)}")
    return updated


def _renamed(source: DataFrame) -> DataFrame:
    return source.select(*[F.col(c).alias(f"__s_{c}") for c in source.columns], F.lit(True).alias(_HIT))


def has_moment(df: DataFrame, col: str) -> bool:
    return col in df.columns and df.schema[col].dataType.typeName() == "timestamp"


def located(table: DataFrame) -> DataFrame:
    """Rows of a table of files with the place of each: its file and its number in there."""
    return table.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def matches(
    target: DataFrame, source: DataFrame, keys: Sequence[str], target_filter: Column | None = None, also: Sequence[str] = ()
) -> DataFrame:
    """The one look at the keys of ``target``, a table of files: keys (and the columns ``also``) and place of every row
    that passes ``target_filter`` and whose key is in ``source``. Only these columns are read and shuffled."""
    active = located(target if target_filter is None else target.where(target_filter))
    return active.select(*keys, *also, FILE, ROW).join(source.select(*keys), list(keys), "left_semi")


def _by_files(target: DataFrame, files: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(rows of the named files with their places, rows of all other files). Up to ``most`` names stand in the filter,
    where they keep the scan from opening other files; beyond that the names are joined."""
    rows = located(target)
    names = [row[0] for row in files.limit(most + 1).collect()]
    if len(names) > most:
        return rows.join(files, FILE, "left_semi"), rows.join(files, FILE, "left_anti")
    path = F.col("_metadata.file_path")
    return located(target.where(path.isin(names))), located(target.where(~path.isin(names)))


def _between(matched: DataFrame, col: str) -> Column:
    """Condition that every matched row meets, from the least and the largest ``col`` among them; a NULL meets it too."""
    ends = matched.agg(F.unix_micros(F.min(col)).alias("lo"), F.unix_micros(F.max(col)).alias("hi")).first()
    if ends["lo"] is None:
        return F.col(col).isNull()
    return F.col(col).isNull() | ((F.col(col) >= micros_lit(ends["lo"])) & (F.col(col) <= micros_lit(ends["hi"])))


def upsert_located(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: DataFrame,
    *,
    range_col: str | None = None,
    files: DataFrame | None = None,
    update_cols: Sequence[str] | None = None,
    newer_by: str | None = None,
    allow_null_keys: bool = False,
    listed_files: int = LISTED_FILES,
) -> DataFrame:
    """Like ``upsert``, for a target of files, from the places that ``matches`` has found; both these and the source
    should be written down, as they are used more than once.

    The target's keys are not looked at again. Files without a match are copied as they are, without a shuffle; in the
    others a row finds its new values by its place. A place is one row, so no key of the target, however hot, gathers
    in one task; source and places are joined to each other only. ``files`` may name the files that hold a match. With
    ``range_col``, a moment that ``matched`` has too, rows outside the range of the matched ones are copied as well: an
    increment mostly meets rows of a short time, and only these are shuffled.
    """
    cols = target.columns
    updated = _updated_columns(cols, keys, update_cols)
    src = source.select(*cols)
    new = _renamed(src)
    placed = matched.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(FILE).alias("__at_file"), F.col(ROW).alias("__at_row"))
    same = reduce(and_, [F.col(f"__k_{k}") == F.col(f"__s_{k}") for k in keys])
    values = placed.join(new, same).select("__at_file", "__at_row", *new.columns)

    hit, untouched = _by_files(target, matched.select(FILE).distinct() if files is None else files, listed_files)
    here = (F.col(FILE) == F.col("__at_file")) & (F.col(ROW) == F.col("__at_row"))
    untouched = untouched.select(*cols)
    if range_col is not None:
        inside = _between(matched, range_col)
        hit, untouched = hit.where(inside), untouched.unionByName(hit.where(~inside).select(*cols))
    merged = hit.join(values, here, "left").select(*_updates(cols, updated, newer_by))
    inserted = src.join(matched.select(*keys).distinct(), list(keys), "left_anti").select(*cols)
    return untouched.unionByName(merged).unionByName(inserted).unionByName(_guard(src, keys, allow_null_keys))


def merge_images(
    target: DataFrame, source: DataFrame, matched: DataFrame, keys: Sequence[str], files: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows before, rows after) of what a merge of whole rows changes: the rows at the matched places as they were, and
    the source rows that take their places or are inserted. Tables that sum up the target follow it by the difference."""
    cols = target.columns
    hit, _ = _by_files(target, matched.select(FILE).distinct() if files is None else files, LISTED_FILES)
    before = hit.join(matched.select(FILE, ROW), [FILE, ROW], "left_semi").select(*cols)
    src = source.select(*cols)
    updated = matched.select(*keys).join(src, list(keys)).select(*cols)
    inserted = src.join(matched.select(*keys).distinct(), list(keys), "left_anti").select(*cols)
    return before, updated.unionByName(inserted)


def upsert_files(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    target_filter: Column | None = None,
    range_col: str = "created_at",
    **options,
) -> DataFrame:
    """``upsert`` of a target of files, with one look at its keys. Source and matches are written to the shared folder.
    ``range_col`` is used where the target has such a moment and it is no key."""
    spark = target.sparkSession
    ranged = has_moment(target, range_col) and range_col not in keys

    def written(df: DataFrame, name: str) -> DataFrame:
        path = fresh_dir(spark, f"upsert/{name}")
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    source = written(source.select(*target.columns), "source")
    matched = written(matches(target, source, keys, target_filter, also=[range_col] if ranged else []), "matched")
    files = written(matched.select(FILE).distinct(), "files")
    return upsert_located(target, source, keys, matched, range_col=range_col if ranged else None, files=files, **options)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    target_filter: Column | None = None,
    update_cols: Sequence[str] | None = None,
    newer_by: str | None = None,
    allow_null_keys: bool = False,
) -> DataFrame:
    """The content of ``target`` after merging ``source`` into it on ``keys``.

    * A target row whose key is in the source takes the source's values, in all columns or only in ``update_cols``;
      source rows without a target row are inserted; other target rows stay, nothing is deleted.
    * Only target rows that pass ``target_filter`` can match. A key whose target row is outside is inserted again.
    * The source must have one row per key, and no NULL key unless ``allow_null_keys``; the job fails otherwise. A
      NULL key never matches, so it is inserted again on every run.
    * With ``newer_by`` a target row that is newer than the source row in that column keeps its values.

    For a target that is a table of files, ``upsert_files`` does the same with a single look at its keys.

    Two joins instead of one full outer join: updates are target ⟕ source, inserts are source ▷ target keys. Adaptive
    execution can split a hot key of the target in the first, the keys of the second are made distinct before they
    are shuffled, and a small source can be broadcast so that the target is not shuffled at all.
    """
    cols = target.columns
    updated = _updated_columns(cols, keys, update_cols)
    active = target if target_filter is None else target.where(target_filter)
    src = source.select(*cols)

    renamed = _renamed(src)
    same = reduce(and_, [active[k] == renamed[f"__s_{k}"] for k in keys])
    merged = active.join(renamed, same, "left").select(*_updates(cols, updated, newer_by))
    known = active.select(*keys).distinct()
    inserted = src.join(known, list(keys), "left_anti").select(*cols)

    result = merged.unionByName(inserted).unionByName(_guard(src, keys, allow_null_keys))
    if target_filter is not None:
        result = result.unionByName(target.where(~F.coalesce(target_filter, F.lit(False))))
    return result
