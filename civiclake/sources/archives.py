"""ZIP archives: one curriculum XML per archive, or a bundle of CSV members.

Archives of one member arrive as ``binaryFile`` rows, so Spark spreads them over the cluster; Python
only opens each archive, batch by batch.  Those of many members are read member by member (``zipfiles``).
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.brazil import DEGREE_STATUSES, NORTHEAST_STATES, compact_date
from ..functions.text import fix_mojibake
from .files import field_count, list_files
from .zipfiles import LINES_PER_BATCH, member_lines, records
from .zipfiles import SCHEMA as MEMBER_LINES

NODE = "struct<attributes: map<string,string>, children: map<string,map<string,string>>>"
PROFILE_SCHEMA = (
    "id_lattes string, raw_date string, hora_atualizacao string, uf_atuacao string, "
    f"general_data {NODE}, professional_performances array<{NODE}>, "
    f"research_projects array<{NODE}>, bibliographic_productions array<{NODE}>, error string"
)
PROFILE_COLUMNS = [
    "id_lattes", "raw_date", "hora_atualizacao", "uf_atuacao", "general_data",
    "professional_performances", "research_projects", "bibliographic_productions", "error",
]


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true").load(path)
    )


def _node(element) -> dict:
    return {"attributes": dict(element.attrib), "children": {c.tag: dict(c.attrib) for c in element}}


def _profile(member: str, content: bytes, states: set[str], statuses: set[str]) -> dict | None:
    """Fields of one curriculum, None if the region or degree filter drops it."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        root = ElementTree.fromstring(archive.read(f"{member}.xml"))
    address = root.find(".//ENDERECO-PROFISSIONAL")
    if address is None or address.get("UF") not in states:
        return None
    degrees = (e for tag in ("MESTRADO", "DOUTORADO", "POS-DOUTORADO") for e in root.iter(tag))
    if not any(e.get("STATUS-DO-CURSO") in statuses for e in degrees):
        return None
    general = root.find("DADOS-GERAIS")
    return {
        "id_lattes": member,
        "raw_date": root.get("DATA-ATUALIZACAO", ""),
        "hora_atualizacao": root.get("HORA-ATUALIZACAO", ""),
        "uf_atuacao": address.get("UF"),
        "general_data": _node(general) if general is not None else {"attributes": {}, "children": {}},
        "professional_performances": [_node(e) for e in root.iter("ATUACAO-PROFISSIONAL")],
        "research_projects": [_node(e) for e in root.iter("PROJETO-DE-PESQUISA")],
        "bibliographic_productions": [_node(e) for e in root.iter("ARTIGO-PUBLICADO")],
        "error": None,
    }


def parse_profiles(
    archives: DataFrame,
    states: list[str] = NORTHEAST_STATES,
    statuses: list[str] = DEGREE_STATUSES,
) -> tuple[DataFrame, DataFrame]:
    """``binaryFile`` rows to (profiles, rejects).

    The cheap filters run inside the parser, before anything else is extracted.  An
    archive that cannot be read becomes a reject row and does not stop the job.
    """
    wanted_states, wanted_statuses = set(states), set(statuses)
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"]):
                member = path.rsplit("/", 1)[-1].removesuffix(".zip")
                try:
                    row = _profile(member, content, wanted_states, wanted_statuses)
                except Exception as exc:  # noqa: BLE001 - any broken archive is a reject row
                    row = {"id_lattes": member, "error": f"{type(exc).__name__}: {exc}"}
                if row is not None:
                    out.append(row)
            yield pd.DataFrame({c: pd.Series([row.get(c) for row in out], dtype=object) for c in PROFILE_COLUMNS})

    parsed = archives.select("path", "content").mapInPandas(parse, PROFILE_SCHEMA)
    rejects = parsed.where("error IS NOT NULL").select("id_lattes", "error")
    profiles = parsed.where("error IS NULL").select(
        "id_lattes",
        compact_date(F.col("raw_date")).alias("data_atualizacao"),
        "hora_atualizacao",
        F.coalesce(
            fix_mojibake(F.try_element_at("general_data.attributes", F.lit("NOME-COMPLETO"))), F.lit("N/A")
        ).alias("nome"),
        "uf_atuacao",
        _clean_node(F.col("general_data")).alias("general_data"),
        *[
            F.transform(F.col(c), _clean_node).alias(c)
            for c in ("professional_performances", "research_projects", "bibliographic_productions")
        ],
    )
    return profiles, rejects


def _clean_node(node):
    fix = lambda _, value: fix_mojibake(value)
    return F.struct(
        F.transform_values(node["attributes"], fix).alias("attributes"),
        F.transform_values(node["children"], lambda _, attrs: F.transform_values(attrs, fix)).alias("children"),
    )


def node_json(node: Column) -> Column:
    """A node as one JSON object: its attributes, and under its name each child's; a child takes the place of an attribute of its name."""
    attributes = F.map_filter(node["attributes"], lambda name, _: ~F.map_contains_key(node["children"], name))
    parts = F.array(*[F.regexp_replace(F.to_json(m), r"^\{|\}$", "") for m in (attributes, node["children"])])
    text = F.concat(F.lit("{"), F.array_join(F.filter(parts, lambda p: p != ""), ","), F.lit("}"))
    return F.when(node.isNotNull(), text)


def profile_json(profiles: DataFrame) -> DataFrame:
    """Profiles with their nodes as JSON text, the shape of the raw table."""
    lists = ("professional_performances", "research_projects", "bibliographic_productions")
    joined = {c: F.concat(F.lit("["), F.array_join(F.transform(F.col(c), node_json), ","), F.lit("]")) for c in lists}
    return profiles.withColumns({"general_data": node_json(F.col("general_data")), **joined})


def read_zip_profiles(spark: SparkSession, path: str, **options) -> tuple[DataFrame, DataFrame]:
    return parse_profiles(list_archives(spark, path), **options)


def unpack_lines(archives: DataFrame, encoding: str = "latin-1", multi_line: bool = False) -> DataFrame:
    """``binaryFile`` rows to (archive, member, line_no, line, error).

    For archives that are rows already, or lie where only Spark can read them: one task opens a whole archive.  Members are decompressed
    as a stream and handed on in bounded batches.  ``multi_line`` keeps line feeds inside quotes in their record.
    """

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        name = path.rsplit("/", 1)[-1]
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for member in archive.infolist():
                    if member.is_dir():
                        continue
                    with archive.open(member) as stream:
                        for n, line in enumerate(records(stream, encoding, multi_line)):
                            if line:
                                yield name, member.filename, n, line, None
        except Exception as exc:  # noqa: BLE001 - any broken archive is a reject row
            yield name, None, None, None, f"{type(exc).__name__}: {exc}"

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["archive", "member", "line_no", "line", "error"]
        for batch in batches:
            chunk = []
            for path, content in zip(batch["path"], batch["content"]):
                for row in rows(path, content):
                    chunk.append(row)
                    if len(chunk) >= LINES_PER_BATCH:
                        yield pd.DataFrame(chunk, columns=names)
                        chunk = []
            yield pd.DataFrame(chunk, columns=names)

    return archives.select("path", "content").mapInPandas(unpack, MEMBER_LINES)


def parse_lines(lines: DataFrame, columns: list[str], separator: str = ";") -> tuple[DataFrame, DataFrame]:
    """Lines of CSV members to (rows, rejects); fields are split on the JVM side."""
    long_line = field_count(F.col("line"), separator) > len(columns)
    bad = F.col("error").isNotNull() | long_line
    options = {"sep": separator, "escape": '"', "multiLine": "true"}
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    fields = F.from_csv("line", ddl, options)
    rows = lines.where(~F.coalesce(bad, F.lit(False))).select(
        "archive", "member", "line_no", fields.alias("f")
    ).select("archive", "member", "line_no", "f.*")
    rejects = lines.where(F.coalesce(bad, F.lit(False))).select("archive", "member", "line_no", "line", "error")
    return rows, rejects


def parse_zip_csv(archives: DataFrame, columns: list[str], separator: str = ";",
                  encoding: str = "latin-1", multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """CSV members of ``binaryFile`` rows to (rows, rejects)."""
    return parse_lines(unpack_lines(archives, encoding, multi_line), columns, separator)


def read_zip_csv(spark: SparkSession, path: str, columns: list[str], separator: str = ";", encoding: str = "latin-1",
                 multi_line: bool = False, pattern: str = "*.zip", files: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """CSV members of the archives below ``path`` (or of just ``files``) to (rows, rejects), one task per member."""
    lines = member_lines(spark, files or list_files(spark, path, pattern), encoding, multi_line)
    return parse_lines(lines, columns, separator)
