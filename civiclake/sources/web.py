"""Landed HTML pages: links, section pairs, file manifests.

Selection is done with JVM regular expressions and array functions, so pages never leave the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pairs import quality_of, summary, zip_pairs
from ..functions.text import clean_html_lists
from ..operators.normalize import explode_rows


#: Elements that may hold others of their name.
NESTED_TAGS = {"article", "blockquote", "div", "ol", "section", "span", "table", "ul"}
#: Elements without an inside.
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass(frozen=True)
class Element:
    """Selects elements of a name (with all the classes), each from its opening tag to the closing one of the same depth."""

    tag: str
    css_class: str | None = None


def tag_text(tag: str, css_class: str | None = None) -> str | Element:
    """Selects the inside of elements.

    Elements that cannot hold their like (paragraphs, links) reach to the first closing tag, and those that are always empty give empty
    texts: both are patterns.  All others are matched by depth, so any number of elements of their name may be inside.
    """
    if tag in NESTED_TAGS:
        return Element(tag, css_class)
    return rf"{opening(tag, css_class)}()" if tag in VOID_TAGS else rf"{opening(tag, css_class)}(.*?)</{tag}\s*+>"


def tag_attribute(tag: str, attribute: str, css_class: str | None = None) -> str:
    """Pattern for an attribute value of an element, in either kind of quotes."""
    value = r"""(?:"([^"]*)"|'([^']*)')"""
    return rf"(?is)<{tag}\b{_classes(css_class)}[^>]*?\s{attribute}\s*=\s*{value}"


class Tags(str):
    """Pattern for tags, matched from their ``<`` and not beyond their ``>``, with the kinds of tags it selects.

    A kind is a name (``/name`` for closing tags) and the classes that a tag must have.
    """

    kinds: frozenset[tuple[str, frozenset[str]]]

    def __new__(cls, pattern: str, kinds) -> Tags:
        self = super().__new__(cls, pattern)
        self.kinds = frozenset(kinds)
        return self

    def narrows(self, other: Tags) -> bool:
        """Whether every tag that this selects is one of ``other``, by fewer of its classes."""
        return all(any(name == n and classes > c for n, c in other.kinds) for name, classes in self.kinds)


def opening(tag: str, css_class: str | None = None) -> Tags:
    """Pattern for the opening tag of an element that has all the classes, in any order."""
    return Tags(rf"(?is)<{tag}\b{_classes(css_class)}[^>]*>", [(tag, frozenset((css_class or "").split()))])


def _classes(names: str | None) -> str:
    return "".join(
        rf"""(?=[^>]*\sclass\s*=\s*(?:"(?:[^"]*\s)?{re.escape(n)}(?:\s[^"]*)?"|'(?:[^']*\s)?{re.escape(n)}(?:\s[^']*)?'))"""
        for n in (names or "").split())


_TWO_QUOTES = r"""(?:"([^"]*)"|'([^']*)')"""
_LAST_QUOTED = r"""(?s)("[^"]*|'[^']*)["']\z"""


def find_all(html: Column, pattern: str | Element) -> Column:
    """All first groups of a pattern; of an attribute pattern, the value in either kind of quotes; the insides of elements."""
    if isinstance(pattern, Element):
        return _bound(elements_only(html), lambda page: insides(page, pattern))
    if not pattern.endswith(_TWO_QUOTES):
        return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    whole = F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    return F.transform(whole, lambda t: F.substring(F.regexp_extract(t, _LAST_QUOTED, 1), 2, 1 << 30))


#: Text that holds no elements, whatever it looks like.
_NO_ELEMENTS = r"<(?is:!--.*?(?:-->|\z)|(script|style)\b.*?(?:</\1\s*+>|\z))"
#: Levels of elements of a name inside a selected one that one pattern matches.
SHALLOW = 4
_OPENS, _SELECTED, _CLOSES, _EMPTY, _NOTHING = range(5)


def elements_only(html: Column) -> Column:
    """A page without comments, scripts and styles."""
    return F.regexp_replace(html, _NO_ELEMENTS, "")


def insides(page: Column, element: Element) -> Column:
    """The insides of all selected elements of a page of ``elements_only`` in page order, an outer one before those in it.

    A closing tag without opening one counts for nothing, an element that is never closed reaches to the end, a tag that closes itself
    is empty.  One pattern matches elements of a few levels, each with the ``<`` that closes it, and gives an empty text for selected
    tags that it cannot match.  A page with such tags is matched by depth instead, with the same result for what the pattern can match.
    """
    return _bound(F.regexp_extract_all(page, F.lit(_shallow(element)), F.lit(1)), lambda found: F.when(
        ~F.array_contains(found, ""), F.transform(found, lambda t: F.substring(t, F.lit(1), F.length(t) - 1))).otherwise(_by_depth(page, element)))


def _insides_of(element: Element) -> Callable[[Column], Column]:
    return lambda page: insides(page, element)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with a lambda variable for the value, so that it is computed once and not wherever it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shallow(element: Element) -> str:
    tag, classes = element.tag, _classes(element.css_class)
    own = rf"<{tag}\b(?!{classes}[^>]*+>)[^>]*+"  # one that is not selected
    other = rf"[^<]++|<(?!/?{tag}\b)|{own}(?<=/)>"
    inside = rf"(?:{other})*+"
    for _ in range(SHALLOW):
        inside = rf"(?:{other}|{own}(?<!/)>{inside}</{tag}\s*+>)*+"
    return rf"(?is)<{tag}\b{classes}[^>]*+>(?:(?<!/>)({inside}<)/{tag}\s*+>)?+"


def _by_depth(page: Column, element: Element) -> Column:
    """The page is cut before every tag of the element's name, and one pass over the pieces keeps the depth and the selected
    elements that are open, by numbers of pieces only, so it is linear in the page."""
    tag = element.tag
    selected, itself = rf"\A{opening(tag, element.css_class)}", r"\A<[^>]*/>"
    pieces = F.split(F.concat(F.lit(" "), page), rf"(?i)(?=</?{tag}\b)", -1)  # the first one is no tag
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.array().cast("array<struct<at: int, depth: int>>").alias("open"),
                     F.array().cast("array<struct<at: int, until: int>>").alias("found"))

    def kind(piece: Column) -> Column:
        return F.when(piece.startswith("</"), _CLOSES).when(~piece.startswith("<"), _NOTHING).when(piece.rlike(selected), F.when(
            piece.rlike(itself), _EMPTY).otherwise(_SELECTED)).when(piece.rlike(itself), _NOTHING).otherwise(_OPENS)

    def step(state: Column, k: Column) -> Column:
        i, depth, stack, found = (state[c] for c in ("i", "depth", "open", "found"))
        top = F.try_element_at(stack, F.lit(-1))
        ends = (k == _CLOSES) & (F.coalesce(top["depth"], F.lit(-1)) == depth)
        span = F.struct(F.when(k == _EMPTY, i).otherwise(top["at"]).alias("at"), i.alias("until"))
        return F.struct(
            (i + 1).alias("i"),
            F.when(k <= _SELECTED, depth + 1).when((k == _CLOSES) & (depth > 0), depth - 1).otherwise(depth).alias("depth"),
            F.when(k == _SELECTED, F.array_append(stack, F.struct(i.alias("at"), (depth + 1).alias("depth")))).when(
                ends, F.slice(stack, F.lit(1), F.size(stack) - 1)).otherwise(stack).alias("open"),
            F.when(ends | (k == _EMPTY), F.array_append(found, span)).otherwise(found).alias("found"))

    def texts(p: Column) -> Column:
        spans = _bound(F.aggregate(F.transform(p, kind), start, step), lambda s: F.array_sort(F.concat(s["found"], F.transform(
            s["open"], lambda o: F.struct(o["at"].alias("at"), s["i"].alias("until"))))))
        return F.transform(spans, lambda s: F.regexp_replace(
            F.array_join(F.slice(p, s["at"] + 1, s["until"] - s["at"]), ""), r"\A<[^>]*>", ""))

    return _bound(pieces, texts)


@dataclass(frozen=True)
class Section:
    """Where a section's labels and values are found on a page.

    ``scope`` narrows the page to the texts from each match of that pattern up to the next
    match of ``scope_end`` (or of itself, or the end); labels may have a scope of their
    own.  Without ``categories`` the section is a plain list of values.
    """

    values: str | Element | None
    categories: str | Element | None = None
    scope: str | None = None
    scope_end: str | None = None
    category_scope: str | None = None
    category_scope_end: str | None = None

    @property
    def usable(self) -> bool:
        return bool(self.values)

    def scopes(self) -> tuple[tuple[str | None, str | None], tuple[str | None, str | None]]:
        """Scope of the values and of the labels."""
        own = (self.scope, self.scope_end)
        return own, ((self.category_scope, self.category_scope_end) if self.category_scope else own)


def area(html: Column, scope: str | None, scope_end: str | None) -> Column:
    """The texts of all matches of a scope, joined."""
    if not scope:
        return html
    parts = F.slice(F.split(html, scope, -1), 2, 1 << 30)
    if scope_end:
        parts = F.transform(parts, lambda part: F.get(F.split(part, scope_end, 2), F.lit(0)))
    return F.coalesce(F.array_join(parts, "\n"), F.lit(""))


#: Stands before the tags where a page is cut; the most pieces that are put together again one by one, the most scopes in a mask.
_MARK, PIECES, SCOPES = "\x01", 1000, 31
#: A tag whose end and attributes are beyond doubt: no angle brackets, and in quotes neither other quotes nor attributes.
_PLAIN_TAG = r"""\A<(?:[^<>"']++|"[^<>"'=]*+"|'[^<>"'=]*+')*+>"""


def _sql(text: str) -> str:
    """A text as an SQL constant, whatever is in it."""
    return f"CAST(X'{text.encode().hex()}' AS STRING)"


def areas(pages: DataFrame, html: str, scopes: dict[tuple[str | None, str | None], str]) -> DataFrame:
    """``area`` of each scope and end as a column of the given name.

    Scopes of tags are found together: the page is cut once before every tag that begins or ends one of them, each piece is graded by its
    tag alone, and an area is put together from pieces.  That gives the same texts as long as the tags are plain; pages on which one is
    not, and all other scopes, are searched for each scope by itself.
    """
    tags = [scope for scope in scopes if isinstance(scope[0], Tags) and isinstance(scope[1], Tags | None)][:SCOPES]
    if not tags:
        return pages.select("*", *[area(F.col(html), *scope).alias(name) for scope, name in scopes.items()])
    bits = {scope: 1 << i for i, scope in enumerate(tags)}
    wanted = list(dict.fromkeys(p for scope in tags for p in scope if p))
    widest = [p for p in wanted if not any(p.narrows(q) for q in wanted)]
    before = "(?=<)(?:" + "|".join(f"(?={p})" for p in widest) + ")"
    pieces = F.slice(F.split(F.regexp_replace(html, before, _MARK), _MARK, -1), 2, 1 << 30)  # nothing begins in the first one
    tagged = F.transform(pieces, lambda p: F.struct(p.alias("text"), F.regexp_extract(p, _PLAIN_TAG, 0).alias("tag")))
    plain = ~F.contains(F.col(html), F.lit(_MARK)) & (F.size("_tagged") <= PIECES) & F.forall("_tagged", lambda p: p["tag"] != "")

    def graded(side: int) -> str:
        """Mask of the scopes that a tag begins (0) or ends (1)."""
        masks = {p: sum(bit for scope, bit in bits.items() if scope[side] == p) for p in wanted}
        return " | ".join(f"IF(({_may_be(p)}) AND p.tag RLIKE {_sql(rf'\A(?:{p})')}, {mask}L, 0L)" for p, mask in masks.items() if mask) or "0L"

    kinds = F.expr(f"""transform(transform(_tagged, p -> struct(p.text AS text, p.tag AS tag, lower(p.tag) AS low)), p -> struct(
      p.text AS text, substring(p.text, length(p.tag) + 1) AS rest, {graded(0)} AS begins, {graded(1)} AS ends))""")
    opened = F.expr("""aggregate(_graded, struct(0L AS open, CAST(array() AS array<struct<text: string, rest: string, begins: bigint, open: bigint>>) AS pieces),
      (a, p) -> struct(a.open & ~p.ends | p.begins AS open, array_append(
        a.pieces, struct(p.text AS text, p.rest AS rest, p.begins AS begins, a.open & ~p.ends | p.begins AS open)) AS pieces)).pieces""")
    layer = pages.select("*", tagged.alias("_tagged")).select("*", kinds.alias("_graded"), plain.alias("_plain"))
    layer = layer.select("*", F.when(F.col("_plain"), opened).alias("_pieces"))

    def found(scope: tuple[str | None, str | None]) -> Column:
        if scope not in bits:
            return area(F.col(html), *scope)
        together = F.expr(f"""array_join(transform(filter(_pieces, p -> p.open & {bits[scope]}L <> 0), (p, i) -> IF(
          p.begins & {bits[scope]}L = 0, p.text, IF(i = 0, p.rest, concat(char(10), p.rest)))), '')""")
        return F.when(F.col("_plain"), together).otherwise(area(F.col(html), *scope))

    return layer.select(*pages.columns, *[found(scope).alias(name) for scope, name in scopes.items()])


def _may_be(tags: Tags) -> str:
    """SQL test on a tag in lower case that holds for all that the pattern matches."""
    return " OR ".join(" AND ".join(f"contains(p.low, {_sql(text.lower())})" for text in (f"<{name}", *sorted(classes)) if text.isascii()) or "true"
                       for name, classes in sorted(tags.kinds, key=str))


_SECTION = Tags(r"(?is)<section\b", [("section", frozenset())])
_BIG_CARD = opening("div", "bigCard")
_GROUP_END = Tags(f"{_BIG_CARD}|{_SECTION}", _BIG_CARD.kinds | _SECTION.kinds)


def _group(name: str) -> dict[str, Tags]:
    return {"scope": opening("div", f"bigCard {name}"), "scope_end": _GROUP_END}


def _card(group: str) -> Section:
    return Section(values=tag_text("div", "card-info"), categories=tag_text("div", "card-title"), **_group(group))


_ATTACHMENTS = {
    "scope": opening("section", "allDocuments"),
    "scope_end": Tags(r"(?i)</section\s*>", [("/section", frozenset())]),
}

# Section layout of a public-works detail page (class names are fixed values).
PUBLIC_WORK_SECTIONS = {
    "general_info": Section(
        values=tag_text("div", "card-info"),
        categories=tag_text("div", "group-title"),
        scope=opening("div", "row-details introducao"),
        scope_end=_GROUP_END,
    ),
    "contract": _card("contrato"),
    # its labels are the values of the contract group
    "contracted": Section(
        values=tag_text("div", "card-info"),
        categories=tag_text("div", "card-info"),
        category_scope=opening("div", "bigCard contrato"),
        category_scope_end=_GROUP_END,
        **_group("contratado"),
    ),
    "fiscal_year_expenditures": _card("despesasExerc"),
    "contract_amendment": _card("aditivo"),
    "cumulative_amount_paid": Section(
        values=tag_text("div", "card-info"),
        categories=tag_text("div", "group-title"),
        **_group("valorPagoAcum"),
    ),
    "all_documents": Section(
        values=tag_attribute("a", "href"), categories=tag_text("p", "cardTitle"), **_ATTACHMENTS
    ),
    "work_location": Section(values=tag_attribute("a", "href"), **_ATTACHMENTS),
}


#: What is known of a section besides its data.
DETAIL = ("struct<method: string, categories_found: int, values_found: int, mapped: int, "
          "categories: struct<status: string, score: decimal(5,2), complete: boolean>, "
          "values: struct<status: string, score: decimal(5,2), complete: boolean>, error: string>")


def _at(lists: str, i: int) -> Column:
    return F.get(F.col(lists), F.lit(i))


def _details(name: str, section: Section, lists: tuple[int, int | None], require_values: bool) -> Column:
    nothing = F.lit(None)
    if not section.usable:
        found = [F.lit("failed"), *[nothing] * 5, F.lit(f"Erro na seção {name}: sem seletor de valores")]
    else:
        v, c = lists
        values, labels = F.size(_at("_lists", v)), F.size(_at("_lists", c)) if section.categories else nothing
        mapped = F.least(values, labels) if section.categories else nothing
        lost = F.when(values == 0, F.lit(f"Erro na seção {name}: nenhum valor na página")) if require_values else nothing
        method = F.lit("paired_data" if section.categories else "list")
        found = [F.when(lost.isNull(), method).otherwise("failed"), labels, values, mapped,
                 quality_of(_at("_found", c), labels) if section.categories else nothing, quality_of(_at("_found", v), values), lost]
    names = ("method", "categories_found", "values_found", "mapped", "categories", "values", "error")
    return F.struct(*[c.alias(n) for c, n in zip(found, names)]).cast(DETAIL)


def extract_sections(pages: DataFrame, url: str, html: str, sections: dict[str, Section],
                     require_values: bool = False, details: bool = False) -> DataFrame:
    """One struct (or list) column per section plus ``extraction_summary``.

    With ``details`` also ``section_details``, a map from each section, failed ones included, to how it was extracted, how much was
    found, the quality of both lists and the error.

    The summary gives processed / successful / failed counts, the rate and its grade.  A
    section fails, and gets no column, if its configuration is unusable; with
    ``require_values`` also if the page holds no value for it.

    The work is laid out in layers (areas, raw matches, cleaned lists, pairs).  Each
    layer is used more than once by the next, so it stays a projection of its own and
    every pattern runs once per page and area, however many sections share it.
    """
    total, every = len(sections), sections
    sections = {name: s for name, s in sections.items() if s.usable}
    scopes: dict[tuple, str] = {}
    elements: dict[Element, list[str]] = {}  # the areas where each is looked for
    others: dict[str, list[str]] = {}

    def sides(section: Section) -> list[tuple[str | Element | None, str]]:
        return [(pattern, scopes.setdefault(scope, f"_area{len(scopes)}")) for pattern, scope in zip((section.values, section.categories), section.scopes())]

    for pattern, at in [side for s in sections.values() for side in sides(s) if side[0]]:
        sought = (elements if isinstance(pattern, Element) else others).setdefault(pattern, [])
        if at not in sought:
            sought.append(at)
    lists = [(pattern, at) for sought in (elements, others) for pattern, found in sought.items() for at in found]
    place = {name: [lists.index(side) if side[0] else None for side in sides(s)] for name, s in sections.items()}

    layer = areas(pages.select(F.col(url).alias("source_url"), F.col(html).alias("_html")), "_html", scopes)
    raw = [F.array(*[find_all(F.col(at), pattern) for pattern, at in lists if pattern in others])] if others or not lists else []
    if elements:
        bare = list(dict.fromkeys(at for found in elements.values() for at in found))
        layer = layer.select("*", F.transform(F.array(*bare), elements_only).alias("_bare"))
        raw = [F.transform(F.array(*[_at("_bare", bare.index(at)) for at in found]), _insides_of(element))
               for element, found in elements.items()] + raw
    layer = layer.select("source_url", F.concat(*raw).cast("array<array<string>>").alias("_lists"))
    if require_values:
        ok = sum((F.when(F.size(_at("_lists", place[name][0])) > 0, 1).otherwise(0) for name in sections), F.lit(0))
    else:
        ok = F.lit(len(sections))
    sizes = [F.transform("_lists", F.size).alias("_found")] if details else []
    layer = layer.select("source_url", clean_html_lists(F.col("_lists")).alias("_lists"), *sizes, ok.alias("_ok"))
    paired = [name for name, s in sections.items() if s.categories]
    both = [F.struct(*[_at("_lists", i).alias(side) for i, side in zip(place[name], "vc")]) for name in paired]
    pairs = [F.transform(F.array(*both), lambda p: zip_pairs(p["c"], p["v"])).alias("_pairs")] if paired else []
    layer = layer.select("*", *pairs)
    columns = [(_at("_pairs", paired.index(name)) if section.categories else _at("_lists", place[name][0])).alias(name)
               for name, section in sections.items()]
    if details:
        known = [x for name, s in every.items() for x in (F.lit(name), _details(name, s, place.get(name, ()), require_values))]
        columns.append(F.create_map(*known).alias("section_details"))
    return layer.select(
        "source_url", *columns, summary(F.lit(total), F.col("_ok")).alias("extraction_summary")
    )


def links(pages: DataFrame, url: str, html: str, css_class: str | None = None,
          container: str | None = None, container_end: str | None = None) -> DataFrame:
    """One row per link of a listing page, in page order; with ``container``, of those scopes only."""
    found = find_all(area(F.col(html), container, container_end), tag_attribute("a", "href", css_class))
    return explode_rows(pages, [F.col(url).alias("page_url")], found, "href", position="position")


def next_page(html: Column) -> Column:
    """Target of the pagination link, null on the last page."""
    return F.get(find_all(html, tag_attribute("a", "href", "next page-numbers")), F.lit(0))


MANIFEST_PREFIXES = ["Empresas", "Estabelecimentos", "Socios"]


def manifest(listing: DataFrame, directory_url: str, href: str,
             prefixes: list[str] = MANIFEST_PREFIXES) -> DataFrame:
    """Registry files named in directory listings.

    Only directories whose last path segment starts with ``20`` count; that segment is
    the batch, the file URL is directory + name, ``member`` is the name without ``.zip``.
    """
    batch = F.element_at(F.split(F.btrim(F.col(directory_url), F.lit("/")), "/"), -1)
    wanted = F.lit(False)
    for prefix in prefixes:
        wanted = wanted | F.col(href).startswith(prefix)
    return listing.select("*", batch.alias("batch")).where(F.col("batch").startswith("20") & wanted).select(
        F.concat(F.rtrim(F.col(directory_url), F.lit("/")), F.lit("/"), F.col(href)).alias("file_url"),
        F.col(href).alias("file_name"),
        F.col("batch").alias("target_dir"),
        member_id(F.col(href)).alias("member"),
    )


def member_id(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"\.zip$", "")
