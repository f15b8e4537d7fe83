"""Column -> Column functions."""

from .brazil import (  # noqa: F401
    brl_money,
    compact_date,
    date_br,
    days,
    doc_kind,
    document_phase,
    document_type,
    full_cnpj,
    ingest_id,
    is_valid_code,
    lookup,
    modality,
    pct,
    pct_band,
    split_amendment_code,
    split_payee,
    status_code,
)
from .pairs import (  # noqa: F401
    confidence,
    list_quality,
    pair_at,
    pair_by_keyword,
    pair_value,
    success_grade,
    zip_pairs,
)
from .text import (  # noqa: F401
    clean_html_list,
    clean_text,
    code_name,
    collapse_spaces,
    fix_mojibake,
    is_blank,
    normal_category,
    short_id,
    strip,
    strip_html,
)
