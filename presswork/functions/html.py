"""Title and body text of a crawled page, in time linear in its length whatever it holds.

Patterns are possessive and end at the next "<" or ">", or reach to the end of the page at most once: what is
left open (a script, a style sheet, a comment) hides the rest. Nesting is counted over pieces of the page.
"""

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_END = r"(?:[ \t\r\n\f/][^<>]*+)?>"
_TITLE_OPENS, _TITLE_CLOSES = rf"(?i)<title{_END}", rf"(?i)</title{_END}"
# A title may hold a few stray "<"; one that is never closed hides nothing.
_INVISIBLE = (
    rf"(?is)<(?:script{_END}.*?(?:</script{_END}|\z)|style{_END}.*?(?:</style{_END}|\z)|!--.*?(?:-->|\z)"
    rf"|title{_END}[^<]*+(?:<(?!/title)[^<]*+){{0,8}}</title{_END})"
)
_ARTICLE_TAG = r"(?i)(?=</?article[ \t\r\n\f/>])"
_ARTICLE_OPENS, _ARTICLE_CLOSES = r"(?i)^<article[ \t\r\n\f/>]", r"(?i)^</article[ \t\r\n\f/>]"
_BODY = rf"(?is)<body{_END}(.*?)(?:</body{_END}|\z)"
_BLOCK_TAG = (
    rf"(?i)</?(?:p|br|div|h[1-6]|ul|ol|li|table|tr|blockquote|section|header|footer|article){_END}"
)
_TAG = r"<[^<>]*+>"
# What follows the "&" of an entity.
_ENTITY = r"^(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"
# Pieces that are counted at a time, so that no array that grows does so with the page.
_TOGETHER = 256


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _names() -> Column:
    """The named entities of HTML 4, with a plain blank for the one that does not break."""
    table = {f"{name};": chr(code) for name, code in name2codepoint.items()}
    table |= {"apos;": "'", "nbsp;": " "}
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _number(entity: Column) -> Column:
    """The character of a numeric entity."""
    digits = F.regexp_extract(entity, r"^#[xX]?([0-9a-fA-F]+);$", 1)
    decimal = ~F.lower(F.substring(entity, 2, 1)).eqNullSafe("x")
    code = F.when(decimal, F.conv(digits, 10, 10)).otherwise(F.conv(digits, 16, 10)).cast("bigint")
    sound = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    wide = F.unhex(F.lpad(F.hex(F.when(sound, code).otherwise(0xFFFD)), 8, "0"))
    mark = F.unhex(F.lit("0000FEFF"))
    return F.when(code == 160, " ").otherwise(F.decode(F.concat(mark, wide), "UTF-32"))


def _decode_entities(text: Column) -> Column:
    """Each entity of the text is replaced once; what that leaves is not read again. Unknown ones stay."""

    def decoded(piece: Column, place: Column) -> Column:
        def put(entity: Column) -> Column:
            known = F.when(F.substring(entity, 1, 1) == "#", _number(entity)).otherwise(F.try_element_at(_names(), entity))
            rest = F.substring(piece, F.length(entity) + 1, F.length(piece))
            return F.coalesce(F.concat(known, rest), F.concat(F.lit("&"), piece))

        return F.when(place == 0, piece).otherwise(_once(F.regexp_extract(piece, _ENTITY, 0), put))

    pieces = F.transform(F.split(text, "&"), decoded)
    return F.when(F.instr(text, "&") == 0, text).otherwise(F.array_join(pieces, ""))


def page_title(html: Column) -> Column:
    """Text of the first title element, on one line; '' when there is none. One left open ends at the next tag."""
    after = F.get(F.split(html, _TITLE_OPENS, 2), F.lit(1))
    parts = F.split(after, _TITLE_CLOSES, 2)
    inside = _once(
        parts, lambda p: F.when(F.size(p) > 1, F.get(p, F.lit(0))).otherwise(F.substring_index(F.get(p, F.lit(0)), "<", 1))
    )
    title = _once(F.regexp_replace(inside, _TAG, ""), _decode_entities)
    title = F.trim(F.regexp_replace(title, r"[ \t\r\n]+", " "))
    return F.when(html.isNotNull(), F.coalesce(title, F.lit("")))


def _depths(steps: Column) -> Column:
    """Running depth of each step, never below none: first over blocks of steps, then inside every block."""
    none = F.array().cast("array<int>")

    def after(depth: Column, step: Column) -> Column:
        return F.greatest(depth + step, F.lit(0))

    def listed(block: Column, depth: Column) -> Column:
        start = F.struct(depth.alias("depth"), none.alias("list"))
        grown = F.aggregate(
            block,
            start,
            lambda s, x: F.struct(
                after(s["depth"], x).alias("depth"), F.concat(s["list"], F.array(after(s["depth"], x))).alias("list")
            ),
        )
        return grown["list"]

    def of_blocks(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("depth"), none.alias("list")),
            lambda s, b: F.struct(
                F.aggregate(b, s["depth"], after).alias("depth"), F.concat(s["list"], F.array(s["depth"])).alias("list")
            ),
        )["list"]
        return F.flatten(F.zip_with(blocks, begins, listed))

    last = F.floor((F.size(steps) - 1) / F.lit(_TOGETHER)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(steps, i * _TOGETHER + 1, F.lit(_TOGETHER)))
    return _once(cut, of_blocks)


def _articles(pieces: Column) -> Column:
    """Content of all article elements, nested ones included, from a page split before its article tags.

    The depth is the count of tags opened less that of tags closed, never below none; an article left open
    reaches to the end. Null if there is none.
    """

    def step(piece: Column) -> Column:
        opens, closes = F.rlike(piece, F.lit(_ARTICLE_OPENS)), F.rlike(piece, F.lit(_ARTICLE_CLOSES))
        return F.when(opens, 1).when(closes, -1).otherwise(0)

    depths = _once(F.transform(pieces, step), _depths)
    kept = _once(depths, lambda d: F.filter(pieces, lambda _, i: F.get(d, i) > 0))
    joined = _once(kept, lambda k: F.when(F.size(k) > 0, F.array_join(k, "\n")))
    return F.when(F.size(pieces) > 1, joined)


def page_text(html: Column) -> Column:
    """Text of the article elements, else of the body, else of the whole page; blocks set apart by a blank line."""

    def main(visible: Column) -> Column:
        body = F.nullif(F.regexp_extract(visible, _BODY, 1), F.lit(""))
        return F.coalesce(_once(F.split(visible, _ARTICLE_TAG), _articles), body, visible)

    text = _once(F.regexp_replace(html, _INVISIBLE, ""), main)
    text = F.regexp_replace(text, _BLOCK_TAG, "\n")
    text = _once(F.regexp_replace(text, _TAG, ""), _decode_entities)
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n\n")
    return F.btrim(text, F.lit(" \n"))
