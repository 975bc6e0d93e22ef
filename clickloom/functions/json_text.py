"""Parsing of JSON objects on a line, with the repair of cut-off lines."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = " \t\r\n\x0b\x0c"


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(_SPACE))


def repaired(line: Column) -> Column:
    """Line without trailing commas and with a closing brace."""
    body = F.rtrim(F.regexp_replace(stripped(line), ",+$", ""), F.lit(_SPACE))
    return F.when(body.endswith("}"), body).otherwise(F.concat(body, F.lit("}")))


def parse_object(line: Column) -> Column:
    """VARIANT of the object that the line is, or null. The repair runs only after a failed parse."""
    text = stripped(line)
    parsed = F.coalesce(F.try_parse_json(text), F.try_parse_json(repaired(line)))
    # A line that parses and starts with a brace holds an object, not a number or a list.
    return F.when(text.startswith("{"), parsed)


_STRING = r'"(?:[^"\\]++|\\.)*+"'


def _object(levels: int) -> str:
    """Pattern of text in braces that balance, up to so many levels of them; braces in strings don't count."""
    inner = f"|{_object(levels - 1)}" if levels else ""
    return rf"\{{(?:[^{{}}\"]++|{_STRING}{inner})*+\}}"


# A single object. Deeper ones don't match, which costs a scan and changes nothing.
_ALONE = rf"(?s)^\s*{_object(3)}[\s,]*$"


def is_alone(line: Column) -> Column:
    """Whether a line is one object for sure, with nothing behind it."""
    return line.rlike(_ALONE)


def framed_objects(line: Column, quotes: bool) -> Column:
    """VARIANTs of all objects on a line, whatever stands before, between and after them.

    One pass over the line cuts it where the braces balance, with regard to quotes or without, as a stray quote or
    brace defeats one of the two. What is left open at the end goes through the repair.
    """
    pieces = _balanced(stripped(line), quotes)
    # A brace alone at the end would be repaired to an empty object.
    return F.filter(F.transform(F.filter(pieces, lambda p: p != "{"), parse_object), lambda v: v.isNotNull())


# Text up to and with a brace or quote. Strings without braces and backslashes are passed over whole: two quotes change
# nothing, whether they open and close a string or close one and open the next.
_TOKENS = r'(?s)(?:[^{}"\\]++|\\.?|"[^{}"\\]*+")*+[{}"]?'


def _balanced(text: Column, quotes: bool) -> Column:
    """Pieces of a text from a brace that opens outside of all to the one that closes it, or to the end.

    A fold over the tokens. With regard to quotes, a closing brace outside of all means nothing; without, it is made
    good by the next one that opens.
    """
    state = F.struct(
        F.lit(1).alias("at"), F.lit(0).alias("depth"), F.lit(1).alias("start"), F.lit(False).alias("quoted"),
        F.array().cast("array<string>").alias("found"),
    )

    def step(s: Column, token: Column) -> Column:
        at, before = s["at"] + F.length(token), s["depth"]
        opens, closes, quoted = F.endswith(token, F.lit("{")), F.endswith(token, F.lit("}")), s["quoted"]
        if quotes:
            opens, closes = opens & ~quoted, closes & ~quoted & (before > 0)
            quoted = quoted != (F.endswith(token, F.lit('"')) & (before > 0))
        depth = F.when(opens, before + 1).when(closes, before - 1).otherwise(before)
        piece = F.substring(text, s["start"], at - s["start"])
        return F.struct(
            at.alias("at"), depth.alias("depth"), F.when((before == 0) & opens, at - 1).otherwise(s["start"]).alias("start"),
            quoted.alias("quoted"), F.when((depth == 0) & (before != 0), F.array_append(s["found"], piece)).otherwise(s["found"]).alias("found"),
        )

    def finish(s: Column) -> Column:
        return F.when(s["depth"] != 0, F.array_append(s["found"], F.substring(text, s["start"], F.length(text)))).otherwise(s["found"])

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0)), state, step, finish)


def type_of(document: Column, name: str) -> Column:
    """Type of a top-level field of a VARIANT as text; null when the field is missing."""
    return F.schema_of_variant(F.try_variant_get(document, f"$.{name}", "variant"))


def truthy(text: Column, kind: Column) -> Column:
    """Truth of a JSON value given as text and type: empty, zero, false, null and missing are false."""
    zero = F.coalesce(text.try_cast("double") == 0, F.lit(False))
    return (
        F.when(text.isNull(), False)
        .when(kind == "STRING", text != "")
        .otherwise(~text.isin("false", "[]", "{}") & ~zero)
    )
