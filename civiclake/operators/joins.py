"""Amendment, document, company and partner joins.

No side is broadcast by hint: the planner does so only for sides it has measured to be
small, everything else is a shuffle join.  One-to-many joins with a data-dependent key
go through ``skew_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.brazil import full_cnpj, is_valid_code, payee_cnpj
from .dedupe import newest_load, one_per_key
from .skew import skew_join


def valid_amendments(amendments: DataFrame, code: str = "codigo_emenda") -> tuple[DataFrame, DataFrame]:
    """Rows with a usable code, and the rejected rest."""
    ok = is_valid_code(F.col(code))
    return amendments.where(ok), amendments.where(~ok)


def amend_documents(amendments: DataFrame, documents: DataFrame, code: str = "codigo_emenda",
                    min_share: float | None = None) -> DataFrame:
    """One row per execution document of a valid amendment.

    Codes are checked on both sides before the shuffle; amendments without documents
    vanish.  Of several rows of an amendment, as repeated loads leave them, the newest counts.
    """
    left, _ = valid_amendments(amendments, code)
    left = one_per_key(left, [code])
    right, _ = valid_amendments(documents, code)
    return skew_join(right, left, code, "inner", min_share=min_share)


def documents_with_works(documents: DataFrame, works: DataFrame, columns: list[str],
                         key: str = "obra_id", min_share: float | None = None) -> DataFrame:
    """Documents left-joined to the chosen columns of their public work."""
    return skew_join(documents, works.select(key, *columns), key, "left", min_share=min_share)


def company_match(payments: DataFrame, establishments: DataFrame, payee: str = "favorecido",
                  min_share: float | None = None) -> DataFrame:
    """Payments matched to the establishment with the payee's full 14-digit id.

    ``establishments`` needs cnpj_basico, cnpj_ordem and cnpj_dv; of several rows of an id the newest counts.
    """
    with_id = payments.withColumn("cnpj", payee_cnpj(F.col(payee)))
    keyed = establishments.withColumn(
        "cnpj", full_cnpj(F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv"))
    )
    return skew_join(with_id, one_per_key(keyed, ["cnpj"]), "cnpj", "inner", min_share=min_share)


def partner_network(companies: DataFrame, establishments: DataFrame, partners: DataFrame,
                    key: str = "cnpj_basico", min_share: float | None = None) -> DataFrame:
    """Partners of every company with a summary of its establishments.

    Establishments are counted per company before the join: joining the two many-sides
    directly would emit partners x establishments rows per company.  Of repeated loads a company's newest rows count.  Tables
    of ``write_colocated`` are joined where they lie.
    """
    companies = one_per_key(companies, [key])
    establishments, partners = newest_load(establishments, key), newest_load(partners, key)
    sites = establishments.groupBy(key).agg(
        F.count("*").alias("establishments"), F.count_distinct("uf").alias("states")
    )
    company = companies.join(sites, key, "left").withColumn(
        "establishments", F.coalesce("establishments", F.lit(0))
    ).withColumn("states", F.coalesce("states", F.lit(0)))
    return skew_join(partners, company, key, "inner", min_share=min_share)


def sector_filter(establishments: DataFrame, cnae: str, column: str = "cnae_fiscal_principal") -> DataFrame:
    return establishments.where(F.col(column) == cnae)


def in_sector(rows: DataFrame, establishments: DataFrame, cnae: str, key: str = "cnpj_basico") -> DataFrame:
    """Rows whose company has an establishment in the sector (semi join on distinct keys)."""
    wanted = sector_filter(establishments, cnae).select(key).distinct()
    return rows.join(wanted, key, "left_semi")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them; null keys do not count.

    Child rows are counted per key first, so the anti join sees every key once.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key")).agg(
        F.count("*").alias("rows")
    )
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def unit_lookup(facts: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """Facts with the name of their management unit."""
    return facts.join(units, key, "left")
