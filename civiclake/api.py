"""The public names in one place."""

from .functions import *  # noqa: F401,F403
from .functions.brazil import payee_cnpj  # noqa: F401
from .operators.dedupe import batch_diff, dedupe_exact, dedupe_latest, same_rows, snapshot_diff, union_counts  # noqa: F401
from .operators.joins import (  # noqa: F401
    amend_documents,
    company_match,
    documents_with_works,
    in_sector,
    orphans,
    partner_network,
    sector_filter,
    unit_lookup,
    valid_amendments,
)
from .operators.normalize import append_by_name, conform, drop_all_null, rename_coerce, stamp, year_window  # noqa: F401
from .operators.profiling import (  # noqa: F401
    completeness,
    date_category,
    executive_summary,
    mixed_score,
    status_flags,
)
from .operators.quality import BRONZE_RULES, Rule, gate, run_rules, select_rules  # noqa: F401
from .operators.ranking import global_index, sample_n, slice_by_rank, top_n  # noqa: F401
from .operators.rollups import (  # noqa: F401
    duplicate_keys,
    duplicate_summary,
    execution_rollup,
    null_counts,
    phase_pivot,
    revenue_rollup,
    section_summary,
    truncation_audit,
    value_counts,
)
from .operators.skew import hot_keys, skew_join  # noqa: F401
from .plans.silver import flatten_works, section_columns, silver_amendments, silver_quotes, work_documents  # noqa: F401
from .plans.spec import CsvTable, PipelineSpec, run_pipeline  # noqa: F401
from .plans.wap import Ledger, RefNotFound  # noqa: F401
from .session import build_session  # noqa: F401
from .sources.archives import read_zip_csv, read_zip_profiles  # noqa: F401
from .sources.files import (  # noqa: F401
    count_by_file,
    create_table_if_missing,
    read_csv_header,
    read_json_documents,
    read_jsonl,
    read_layout_csv,
    write_csv_header,
    write_json_arrays,
    write_jsonl,
    write_table,
)
from .sources.schemas import (  # noqa: F401
    AMENDMENT,
    AMENDMENT_DOCUMENTS,
    COMPANIES,
    ESTABLISHMENTS,
    PARTNERS,
    TABLES,
    bronze,
    layout_for,
    strings,
)
from .sources.payload import (  # noqa: F401
    allowance_files,
    document_request,
    explode_payload,
    explode_revenue,
    map_fields,
    page_plan,
    revenue_funds,
    revenue_movements,
    unit_dictionary,
)
from .sources.web import PUBLIC_WORK_SECTIONS, Section, extract_sections, links, manifest, next_page  # noqa: F401
from .streaming.ingest import stream_pipeline  # noqa: F401

read_zip_xml = read_zip_profiles
