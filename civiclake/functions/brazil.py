"""Brazilian public-data formats: money, dates, ids, budget codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip

MONEY = T.DecimalType(18, 2)
PERCENT = T.DecimalType(9, 4)

# They must equal the published vocabulary for right results.
MODALITY_SYNONYMS = {
    "PREGÃO": "PREGÃO",
    "PREG": "PREGÃO",
    "CP": "CARTA PROPOSTA",
    "TP": "TOMADA DE PREÇO",
    "TOMADA": "TOMADA DE PREÇO",
    "CONCORRÊNCIA": "CONCORRÊNCIA",
    "CV": "CONVITE",
    "CONVITE": "CONVITE",
    "DISPENSA": "DISPENSA",
    "DISP": "DISPENSA",
    "INEXIGIBILIDADE": "INEXIGIBILIDADE",
}
STATUS_CODES = {
    "Concluída": "CONCLUIDA",
    "em Andamento": "EM_ANDAMENTO",
    "Contrato Rescindido": "RESCINDIDA",
    "Paralisada": "PARALISADA",
}
DOCUMENT_PHASES = {"NE": "Empenho", "NS": "Liquidação", "OB": "Pagamento"}
PHASES = ["Empenho", "Liquidação", "Pagamento"]
NORTHEAST_STATES = ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"]
DEGREE_STATUSES = ["CONCLUIDO", "EM_ANDAMENTO"]
PCT_BANDS = [(25, "0-25%"), (50, "25-50%"), (75, "50-75%"), (100, "75-100%")]
VALID_CODE = r"\A[0-9]{10,14}\z"
# end of fixed values


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Value of a small constant dictionary, null if the key is unknown."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(entries, c)


def brl_money(c: Column) -> Column:
    """``R$ 1.234,56`` to DECIMAL(18,2); empty, ``-`` and unparsable give null.

    Dots are thousands marks and are dropped, so the input must be in Brazilian format.
    """
    digits = F.translate(F.replace(c, F.lit("R$"), F.lit("")), ",.", ".")
    return strip(digits).try_cast(MONEY)


def pct(c: Column) -> Column:
    """``45,5%`` to DECIMAL(9,4); a thousands dot is not accepted."""
    plain = F.replace(F.replace(c, F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    return strip(plain).try_cast(PERCENT)


def date_br(c: Column) -> Column:
    """``dd/MM/yyyy`` to DATE, impossible dates give null."""
    return F.try_to_date(c, "d/M/yyyy")


def days(c: Column) -> Column:
    """First ``<n> dia(s)`` in the text as a whole number."""
    return F.regexp_extract(c, r"(?i)(\d+)\s*dias?", 1).try_cast("bigint")


def modality(c: Column) -> Column:
    """First word, upper-cased, through the synonym table."""
    word = F.regexp_extract(F.upper(c), r"(?U)(\S+)", 1)
    return F.when(word != "", F.coalesce(lookup(word, MODALITY_SYNONYMS), word))


def doc_kind(c: Column) -> Column:
    """CPF (11 characters) or CNPJ (14) once punctuation is removed; else ``IRRGULAR``."""
    size = F.length(strip(F.translate(c, ".-/", "")))
    return F.when(c != "", F.when(size == 11, "CPF").when(size == 14, "CNPJ").otherwise("IRRGULAR"))


_PAYEE_ID = (
    r"\A\s*(\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}|\d{14}"
    r"|[\d*]{3}\.\d{3}\.\d{3}-[\d*]{2}|\d{11})(?:\s+-\s+|\s*\z)"
)


def split_payee(c: Column) -> Column:
    """``"<id> - <name>"`` as ``struct<id,name,kind>``; id holds digits only.

    kind is CNPJ, CPF or ``outro``; for ``outro`` the whole text is the name.  The pattern
    runs once per row: it marks the end of the id, and a one-element list carries the
    marked text to the fields.
    """
    mark = "\u0001"
    marked = F.regexp_replace(F.translate(c, mark, " "), _PAYEE_ID, "$1" + mark)

    def fields(text: Column) -> Column:
        known = F.instr(text, mark) > 0
        digits = F.translate(F.substring_index(text, mark, 1), ".-/*", "")
        name = strip(F.when(known, F.substring_index(text, mark, -1)).otherwise(text))
        kind = F.when(text.isNotNull(), F.when(~known, "outro").when(F.length(digits) == 14, "CNPJ").otherwise("CPF"))
        return F.struct(
            F.when(known, digits).alias("id"), F.when(name != "", name).alias("name"), kind.alias("kind"))

    return F.transform(F.array(marked), fields)[0]


def payee_cnpj(c: Column) -> Column:
    """The 14 digits of a payee identified by CNPJ, else null (cheaper than ``split_payee``)."""
    token = F.regexp_extract(c, r"\A\s*(\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}|\d{14})(?:\s+-\s+|\s*\z)", 1)
    return F.nullif(F.translate(token, "./-", ""), F.lit(""))


def status_code(c: Column) -> Column:
    return lookup(c, STATUS_CODES)


def pct_band(c: Column) -> Column:
    """Right-closed completion band, lowest edge included; out of range gives null."""
    band = F.when(c < 0, F.lit(None))
    for upper, label in PCT_BANDS:
        band = band.when(c <= upper, label)
    return band


def compact_date(c: Column) -> Column:
    """``DDMMYYYY`` to ISO text if it has eight characters, else the raw text or ''."""
    iso = F.concat_ws("-", F.substring(c, 5, 4), F.substring(c, 3, 2), F.substring(c, 1, 2))
    return F.when(F.length(c) == 8, iso).otherwise(F.coalesce(c, F.lit("")))


def is_valid_code(c: Column) -> Column:
    """Amendment code of 10 to 14 digits; null is false."""
    return F.coalesce(c.rlike(VALID_CODE), F.lit(False))


def split_amendment_code(c: Column) -> Column:
    """year(4) + author(5) + sequence(3)."""
    return F.struct(
        F.substring(c, 1, 4).alias("year"),
        F.substring(c, 5, 5).alias("author"),
        F.substring(c, 10, 3).alias("sequence"),
    )


def document_type(c: Column) -> Column:
    """Two-letter type inside a document code such as ``2025OB271828``."""
    kind = F.regexp_extract(c, r"\A[0-9]{4}([A-Z]{2})", 1)
    return F.when(kind != "", kind)


def document_phase(c: Column) -> Column:
    return lookup(document_type(c), DOCUMENT_PHASES)


def full_cnpj(base: Column, order: Column, check: Column) -> Column:
    return F.concat(base, order, check)


def ingest_id(name: str | Column, ts: Column) -> Column:
    """``ingest_<name>_<yyyyMMdd_HHmmss>``."""
    name = F.lit(name) if isinstance(name, str) else name
    return F.concat(F.lit("ingest_"), name, F.lit("_"), F.date_format(ts, "yyyyMMdd_HHmmss"))
