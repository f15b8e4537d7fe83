"""Category/value pair arrays as found on detail pages."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import has_text


def confidence(category: Column, value: Column) -> Column:
    """low if either is empty, high if both have visible characters, else medium."""
    empty = F.coalesce((category == "") | (value == ""), F.lit(True))
    return F.when(empty, "low").when(has_text(category) & has_text(value), "high").otherwise("medium")


def zip_pairs(categories: Column, values: Column) -> Column:
    """Pair two lists up to the shorter length and grade the pairing.

    struct<paired_data: array<struct<category,value,pair_index,confidence>>,
    pairing_quality, unpaired_values, paired_ratio, total_pairs>
    """
    n_cat, n_val = F.size(categories), F.size(values)
    n = F.least(n_cat, n_val)
    # both sides travel inside the list, so the lambda never recomputes one of them
    both = F.arrays_zip(F.slice(categories, 1, n).alias("category"), F.slice(values, 1, n).alias("value"))
    paired = F.transform(
        both,
        lambda p, i: F.struct(
            p["category"].alias("category"),
            p["value"].alias("value"),
            i.alias("pair_index"),
            confidence(p["category"], p["value"]).alias("confidence"),
        ),
    )
    quality = (
        F.when(n_cat == n_val, "excellent")
        .when(n * 10 > F.greatest(n_cat, n_val) * 8, "good")
        .otherwise("poor")
    )
    return F.struct(
        paired.alias("paired_data"),
        quality.alias("pairing_quality"),
        F.slice(values, n + 1, n_val - n).alias("unpaired_values"),
        F.concat(n.cast("string"), F.lit("/"), n_val.cast("string")).alias("paired_ratio"),
        n.alias("total_pairs"),
    )


def pair_value(pairs: Column, key: str) -> Column:
    """Value of the last pair whose lower-cased category equals ``key``."""
    hits = F.filter(pairs, lambda p: F.lower(p["category"]) == key)
    return F.try_element_at(hits, F.lit(-1))["value"]


def pair_at(pairs: Column, position: int, field: str) -> Column:
    """``category`` or ``value`` of the pair at a position, null if there is none."""
    return F.get(pairs, F.lit(position))[field]


def pair_by_keyword(pairs: Column, rules: dict[str, list[str]], target: str) -> Column:
    """Value for ``target`` under ordered keyword rules.

    A pair belongs to the first rule one of whose keywords its category contains;
    of several pairs for one target the last wins.
    """
    names = list(rules)
    any_of = {name: "|".join(re.escape(word) for word in rules[name]) for name in names}

    def owned(p: Column) -> Column:
        category = F.lower(p["category"])
        mine = category.rlike(any_of[target])
        for earlier in names[: names.index(target)]:
            mine = mine & ~category.rlike(any_of[earlier])
        return F.coalesce(mine, F.lit(False))

    return F.try_element_at(F.filter(pairs, owned), F.lit(-1))["value"]


def list_quality(raw: Column, cleaned: Column) -> Column:
    """struct<status, score, complete> for a raw list and what cleaning left of it."""
    return quality_of(F.size(raw), F.size(cleaned))


def quality_of(n_raw: Column, n_clean: Column) -> Column:
    """``list_quality`` from the sizes of both lists."""
    some = n_raw > 0
    ratio = F.try_divide(n_clean.cast("decimal(12,0)"), n_raw.cast("decimal(12,0)"))
    return F.struct(
        F.when(~some, "no_data").when(n_clean * 10 > n_raw * 7, "good").otherwise("needs_review").alias("status"),
        F.when(some, F.round(ratio, 2)).otherwise(F.lit(0)).cast("decimal(5,2)").alias("score"),
        F.when(some, n_clean > 0).alias("complete"),
    )


def success_grade(rate: Column) -> Column:
    """Grade of the share of sections extracted; the first label keeps its published spelling."""
    return F.when(rate >= 0.9, "excelent").when(rate >= 0.7, "good").otherwise("needs_improvement")


def summary(total: Column, ok: Column) -> Column:
    """struct<processed, successful, failed, success_rate, grade>."""
    rate = F.coalesce(F.try_divide(ok.cast("decimal(12,0)"), total.cast("decimal(12,0)")), F.lit(0))
    return F.struct(
        total.cast("bigint").alias("processed"),
        ok.cast("bigint").alias("successful"),
        (total - ok).cast("bigint").alias("failed"),
        F.round(rate, 2).cast("decimal(5,2)").alias("success_rate"),
        success_grade(rate).alias("grade"),
    )
