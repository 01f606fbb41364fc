"""Template slots: learn the map, apply it, invert it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmill.functions import fixed, text
from pairmill.functions.basics import compute_once, empty_strings
from pairmill.functions.render import is_slot, render
from pairmill.operators.lookup import in_rows, lookup
from pairmill.settings import Settings
from pairmill.sources.staging import stage


def slot_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """How often each raw slot name occurs over all ``cols``, one scan."""
    names = F.concat(*[F.coalesce(text.slot_names(F.col(c)),
                                  F.array().cast("array<string>")) for c in cols])
    return (df.select(F.explode(names).alias("raw"))
            .groupBy("raw").agg(F.count("*").alias("n")))


def slot_map(df: DataFrame, cols: list[str],
             min_freq: int = Settings.slot_min_freq) -> DataFrame:
    """raw name -> typed slot; rare names share the generic slot."""
    slot = F.when(F.col("n") >= min_freq, text.slug(F.col("raw"))).otherwise(fixed.GENERIC_SLOT)
    return slot_counts(df, cols).select("raw", slot.alias("slot"), "n")


def slot_types(mapping: DataFrame) -> DataFrame:
    return mapping.agg(F.count_distinct("slot").alias("placeholder_types"))


def frequent(mapping: DataFrame) -> DataFrame:
    """Entries that differ from the default; the only ones a lookup needs."""
    return mapping.where(F.col("slot") != fixed.GENERIC_SLOT)


#: Bytes of names that a constant map in the plan may hold.
LITERAL_BYTES = 1_000_000


def fits_in_plan(mapping: DataFrame, settings: Settings = Settings()) -> bool:
    """Whether the entries of a (staged) map that matter are few and short enough for a constant."""
    size = frequent(mapping).agg(F.count("*").alias("n"), F.sum(F.octet_length("raw")).alias("bytes")).first()
    return size["n"] <= settings.literal_entries and (size["bytes"] or 0) <= LITERAL_BYTES


def small_map(mapping: DataFrame, settings: Settings = Settings()) -> dict[str, str]:
    """The map as a constant, most frequent first; only of a map that ``fits_in_plan``."""
    rows = (frequent(mapping).orderBy(F.desc("n"), "raw")
            .limit(settings.literal_entries + 1).collect())
    if len(rows) > settings.literal_entries:
        raise ValueError(f"the slot map has more than {settings.literal_entries} entries")
    return {r.raw: r.slot for r in rows}


def inverse_map(mapping: DataFrame) -> DataFrame:
    """slot -> raw name; of colliding names the most frequent, then the first."""
    w = Window.partitionBy("slot").orderBy(F.desc("n"), "raw")
    return (frequent(mapping).withColumn("_rn", F.row_number().over(w))
            .where("_rn = 1").select("slot", "raw"))


def apply_slots_df(df: DataFrame, column: str, mapping: DataFrame, key: str | Sequence[str] = "row_id",
                   settings: Settings = Settings()) -> DataFrame:
    """Slot substitution through a join, for maps beyond an in-plan constant. ``key`` is a column, or
    columns, that tell the rows apart."""
    keys = [key] if isinstance(key, str) else list(key)
    names = (df.where(F.contains(F.col(column), F.lit("{{")))
             .select(*keys, F.posexplode(text.slot_names(F.col(column))).alias("pos", "raw")))
    found = lookup(names, frequent(mapping).select("raw", "slot"), "raw", settings)
    slot = F.coalesce("slot", F.lit(fixed.GENERIC_SLOT))
    per_row = (found.groupBy(*keys)
               .agg(F.array_sort(F.collect_list(F.struct("pos", slot.alias("slot")))).alias("_s"))
               .select(*keys, F.col("_s.slot").alias("_slots")))
    filled = F.when(F.col("_slots").isNull(), F.col(column)).otherwise(
        text.fill_slots(F.col(column), F.col("_slots")))
    return df.join(per_row, keys, "left").withColumn(column, filled).drop("_slots")


def fill_columns(df: DataFrame, columns: list[str], mapping: DataFrame, key: str | Sequence[str] = "row_id",
                 settings: Settings = Settings()) -> DataFrame:
    """Slot substitution in several columns by a (staged) map beyond an in-plan constant. Names are looked up
    inside their rows where the map is of broadcast size, and by a join else."""
    call = in_rows(frequent(mapping), "raw", "slot", "string", settings)
    if call is None:
        for c in columns:
            df = apply_slots_df(df, c, mapping, key, settings)
        return df
    has_slot = {c: F.contains(F.col(c), F.lit("{{")) for c in columns}
    found = df.withColumns({f"_s{c}": call(F.when(has_slot[c], text.slot_names(F.col(c)))) for c in columns})
    return found.withColumns({c: F.when(has_slot[c], text.fill_slots(F.col(c), F.transform(
        f"_s{c}", lambda s: F.coalesce(s, F.lit(fixed.GENERIC_SLOT))))).otherwise(F.col(c)) for c in columns}).drop(
        *[f"_s{c}" for c in columns])


def render_df(df: DataFrame, columns: dict[str, str], mapping: DataFrame | None,
              key: str | Sequence[str] = "row_id", settings: Settings = Settings()) -> DataFrame:
    """Add readable texts of token columns, ``{tokens: output}``, with the raw names of a (staged) slot
    map of any size.

    A small map is a constant in the plan, and one of broadcast size is looked up inside the rows. For a larger
    one the slots of all columns leave their rows with place and column, meet the inverse map in one dictionary
    join, and come back in order, before the spacing rules run inside the row. ``key`` is a column, or columns, that tell the rows apart.
    """
    if mapping is None or fits_in_plan(mapping, settings):
        inverse = {} if mapping is None else {r.slot: r.raw for r in inverse_map(mapping).collect()}
        return compute_once(df, **{out: render(F.col(c), inverse) for c, out in columns.items()})
    keys = [key] if isinstance(key, str) else list(key)
    inverse = stage(inverse_map(mapping), "inverse-slots")

    def in_order(c: str) -> Column:
        return F.filter(F.coalesce(c, empty_strings()), is_slot)

    call = in_rows(inverse, "slot", "raw", "string", settings)
    if call is not None:
        names = df.withColumns({f"_n{out}": call(in_order(c)) for c, out in columns.items()})
        return compute_once(names, **{out: render(F.col(c), None, F.col(f"_n{out}")) for c, out in columns.items()}).drop(
            *[f"_n{out}" for out in columns.values()])

    def placed(c: str, out: str) -> Column:
        return F.transform(in_order(c), lambda t, i: F.struct(F.lit(out).alias("col"), i.alias("pos"), t.alias("slot")))

    places = F.concat(*[placed(c, out) for c, out in columns.items()])
    found = lookup(df.select(*keys, F.inline(places)), inverse, "slot", settings)
    named = found.groupBy(*keys).agg(F.struct(*[F.array_sort(F.collect_list(
        F.when(F.col("col") == out, F.struct("pos", "raw")))).alias(out) for out in columns.values()]).alias("_n"))
    texts = {out: render(F.col(c), None, F.coalesce(F.col(f"_n.{out}.raw"), empty_strings()))
             for c, out in columns.items()}
    return compute_once(df.join(named, keys, "left"), **texts).drop("_n")
