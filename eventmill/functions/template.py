"""Message templates as column expressions: tokens, rendering, formatted tokens.

Properties come as ``map<name, JSON text>``, the form they also have in the
document, so nothing is parsed twice: the JSON text of a number is its
rendering, and so is that of a string without escapes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.jsontext import let, string_json

# Escaped braces come first so that ``{{literal}}`` holds no token.
TOKEN = r"(\{\{|\}\}|\{[@$]?\w+(?:,-?\d+)?(?::[^{}]*)?\}|[^{}]+|[{}])"
HOLE = r"^\{[@$]?(\w+)(?:,(-?\d+))?(?::([^{}]*))?\}$"

# Beyond this a format is left out; a decimal has 38 digits, and as many are left for the whole part.
MAX_FRACTION_DIGITS = 18
# How many templates get an expression of their own.
COMMON_TEMPLATES = 64


def tokens(template: Column) -> Column:
    """The template cut into text, escapes and holes, in order."""
    return F.regexp_extract_all(template, F.lit(TOKEN), F.lit(1))


def is_hole(token: Column) -> Column:
    """Whether a token of :func:`tokens` names a property."""
    return token.startswith("{") & (F.length(token) > 2)


def holes(template: Column) -> Column:
    """The property tokens of a template."""
    return F.filter(tokens(template), is_hole)


def hole_name(token: Column) -> Column:
    return F.regexp_extract(token, HOLE, 1)


def parsed_tokens(template: Column) -> Column:
    """Tokens with the name, width and format of holes; other tokens have no name."""
    def one(token: Column) -> Column:
        hole = is_hole(token)
        plain = hole & ~token.rlike("[,:@$]")
        return F.struct(
            token.alias("raw"),
            F.when(plain, F.substring(token, F.lit(2), F.length(token) - 2)).when(hole, hole_name(token)).alias("name"),
            F.when(hole & token.contains(","), F.regexp_extract(token, HOLE, 2).try_cast("int")).alias("width"),
            F.when(hole & token.contains(":"), F.regexp_extract(token, HOLE, 3)).otherwise("").alias("format"))

    return F.transform(tokens(template), one)


def _rounded(text: Column, places: int) -> Column:
    """Number text with so many fraction digits, rounded once, halves away from zero.

    Numbers too large for that many digits have no fraction left to round.
    """
    number = text.try_cast(f"decimal(38,{places})").cast("string")
    if not places:
        return number
    large = F.concat(text.try_cast("decimal(38,0)").cast("string"), F.lit("." + "0" * places))
    return F.coalesce(number, large)


def _fixed(number: Column, digits: Column) -> Column:
    """Number text with a varying count of fraction digits."""
    def pick(count: Column) -> Column:
        text = F.when(count == 0, _rounded(number, 0))
        for places in range(1, MAX_FRACTION_DIGITS + 1):
            text = text.when(count == places, _rounded(number, places))
        return text

    return let(digits, pick)


def _padded(text: Column, whole_digits: Column) -> Column:
    """Zeros in front of the whole part up to ``whole_digits``."""
    def pad(number: Column) -> Column:
        missing = whole_digits - F.length(F.substring_index(F.ltrim(number, F.lit("-")), ".", 1))
        zeros = F.repeat(F.lit("0"), F.greatest(missing, F.lit(0)))
        return F.concat(F.when(number.startswith("-"), "-").otherwise(""), zeros, F.ltrim(number, F.lit("-")))

    return let(text, pad)


def _grouped(text: Column) -> Column:
    """Thousands separators in the whole part."""
    return F.regexp_replace(text, r"(?<=\d)(?<!\.\d{0,18})(?=(?:\d{3})+(?:\.|$))", ",")


def _is_whole(text: Column) -> Column:
    """Whether number text has no fraction: written without one, or with zeros alone."""
    return text.rlike(r"^-?\d+(\.0*)?$")


#: A pattern of digits: whole part with thousands separators, then fraction digits that are shown always and those that are not.
PATTERN = r"^([#0]+(?:,[#0]+)*)(?:\.(0*)(#*))?$"
#: Formats that are followed; ``G`` and ``R`` show a number as it is.
SUPPORTED = PATTERN[:-1] + r"$|^[FfNnPpEe]\d?$|^[DdXx]\d{0,2}$|^[GgRr]$"


def supported_format(fmt: Column) -> Column:
    """Whether a number under this format is rendered by it; another one leaves the number as it is."""
    return fmt.rlike(SUPPORTED)


def _patterned(rounded: Column, least_whole: Column, grouped: Column, least_fraction: Column) -> Column:
    """A number rounded to all its places, with whole digits at least, separators, and no zeros behind the digits that must be shown."""
    def show(number: Column) -> Column:
        bare = F.ltrim(number, F.lit("-"))
        places = F.when(bare.contains("."), F.substring_index(bare, ".", -1)).otherwise("")
        shown = F.substring(places, F.lit(1), F.greatest(F.length(F.rtrim(places, F.lit("0"))), least_fraction))
        whole = F.substring_index(bare, ".", 1)
        whole = F.when((whole == "0") & (least_whole == 0), "").otherwise(
            F.concat(F.repeat(F.lit("0"), F.greatest(least_whole - F.length(whole), F.lit(0))), whole))
        return F.concat(F.when(number.startswith("-"), "-").otherwise(""), F.when(grouped, _grouped(whole)).otherwise(whole),
                        F.when(shown != "", F.concat(F.lit("."), shown)).otherwise(""))

    return let(rounded, show)


def _percent(text: Column) -> Column:
    """A hundred times the number, exactly."""
    return (text.try_cast("decimal(36,18)") * 100).cast("string")


def _exponent(text: Column, fmt: Column) -> Column:
    """``d.ddE+ddd`` with the digits that the format names, six without."""
    digits = F.coalesce(F.substring(fmt, 2, 2).try_cast("int"), F.lit(6))
    shown = F.printf(F.concat(F.lit("%."), digits.cast("string"), F.lit("E")), text.try_cast("double"))
    shown = F.regexp_replace(shown, r"E([+-])(\d\d)$", "E$10$2")
    return F.when(fmt.startswith("e"), F.lower(shown)).otherwise(shown)


def _hexadecimal(text: Column, fmt: Column) -> Column:
    """A whole number in base 16; a negative one as its 32 or, beyond that range, 64 bits."""
    def show(number: Column) -> Column:
        digits = F.when(number.between(-(1 << 31), -1), F.right(F.hex(number), F.lit(8))).otherwise(F.hex(number))
        missing = F.coalesce(F.substring(fmt, 2, 2).try_cast("int"), F.lit(0)) - F.length(digits)
        padded = F.concat(F.repeat(F.lit("0"), F.greatest(missing, F.lit(0))), digits)
        return F.when(fmt.startswith("x"), F.lower(padded)).otherwise(padded)

    return let(F.when(_is_whole(text), text.try_cast("decimal(38,0)").try_cast("bigint")), show)


def formatted_number(text: Column, fmt: Column) -> Column:
    """Number text under patterns of ``0``, ``#`` and ``,``, ``Fn``, ``Nn``, ``Pn``, ``En``, ``Dn`` or ``Xn``; other formats leave it as it is."""
    fraction = F.when(fmt.contains("."), F.length(F.substring_index(fmt, ".", -1))).otherwise(0)
    whole = F.length(F.substring_index(fmt, ".", 1))
    precision = F.coalesce(F.substring(fmt, 2, 2).try_cast("int"), F.lit(2))
    least_whole = F.length(F.ltrim(F.replace(F.substring_index(fmt, ".", 1), F.lit(",")), F.lit("#")))  # digits count from the first zero on
    least_fraction = F.length(F.regexp_extract(fmt, PATTERN, 2))
    return F.coalesce(
        F.when(fmt.rlike(r"^0+(\.0+)?$"), _padded(_fixed(text, fraction), whole))
        .when(fmt.rlike(r"^[Ff]\d?$"), _fixed(text, precision))
        .when(fmt.rlike(r"^[Nn]\d?$"), _grouped(_fixed(text, precision)))
        .when(fmt.rlike(r"^[Dd]\d{0,2}$") & _is_whole(text),
              _padded(_rounded(text, 0), F.coalesce(F.substring(fmt, 2, 2).try_cast("int"), F.lit(0))))
        .when(fmt.rlike(r"^[Pp]\d?$"), F.concat(_grouped(_fixed(_percent(text), precision)), F.lit(" %")))
        .when(fmt.rlike(r"^[Ee]\d?$"), _exponent(text, fmt))
        .when(fmt.rlike(r"^[Xx]\d{0,2}$"), _hexadecimal(text, fmt))
        .when(fmt.rlike(PATTERN), _patterned(_fixed(text, fraction), least_whole, fmt.contains(","), least_fraction)),
        text,
    )


def unsupported_formats(events: DataFrame, template: str = "message_template") -> DataFrame:
    """``(message_template, format, n)`` of formats that are not followed for numbers, with the events that have them.

    Templates are parsed once each. ``l`` is for strings; times carry their format in their text.
    """
    seen = events.groupBy(template).agg(F.count(F.lit(1)).alias("n"))
    formats = F.array_distinct(F.transform(F.filter(parsed_tokens(F.col(template)), lambda t: F.coalesce(t["format"], F.lit("")) != ""), lambda t: t["format"]))
    return seen.select(template, "n", F.explode(formats).alias("format")).filter(~supported_format(F.col("format")) & (F.col("format") != "l")).select(template, "format", "n")


def _plain_text(value: Column) -> Column:
    """The rendering without a format: strings keep their quotes, and only quotes stay escaped."""
    string = F.try_variant_get(F.try_parse_json(value), "$", "string")
    quoted = F.concat(F.lit('"'), F.replace(string, F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when(value.startswith('"') & value.contains("\\"), quoted).otherwise(value)


def _value_text(value: Column, fmt: Column) -> Column:
    """The rendering of a property given as JSON text."""
    bare = F.when(value.contains("\\"), F.try_variant_get(F.try_parse_json(value), "$", "string")).otherwise(
        F.substring(value, F.lit(2), F.length(value) - 2))
    return (
        F.when(fmt == "", _plain_text(value))
        .when(value.startswith('"'), F.when(fmt == "l", bare).otherwise(_plain_text(value)))
        .when(fmt == "l", value)
        .otherwise(formatted_number(value, fmt))
    )


def _aligned(text: Column, width: Column) -> Column:
    """Spaces up to ``width``; a negative width puts them behind."""
    return let(text, lambda t: let(F.repeat(F.lit(" "), F.abs(width) - F.length(t)), lambda gap:
        F.when(width > 0, F.concat(gap, t)).otherwise(F.concat(t, gap))))


def rendered_tokens(template: Column, properties: Column) -> Column:
    """Parsed tokens with their text; a hole without a property stays as written."""
    def literal(raw: Column) -> Column:
        return F.when(raw == "{{", "{").when(raw == "}}", "}").otherwise(raw)

    def fill(token: Column, value: Column) -> Column:
        text = _value_text(value, token["format"])
        return (
            F.when(token["name"].isNull(), literal(token["raw"]))
            .when(value.isNull(), token["raw"])
            .when(token["width"].isNull(), text)
            .otherwise(_aligned(text, token["width"])))

    def with_text(props: Column) -> Column:
        found = F.transform(parsed_tokens(template), lambda t: F.struct(
            t.alias("token"), F.when(t["name"].isNotNull(), F.try_element_at(props, t["name"])).alias("value")))
        return F.transform(found, lambda f: F.struct(
            f["token"]["name"].alias("name"), f["token"]["format"].alias("format"),
            fill(f["token"], f["value"]).alias("text")))

    return let(properties, with_text)


def _message(filled: Column) -> Column:
    return F.array_join(F.transform(filled, lambda t: t["text"]), "")


def _renderings(filled: Column) -> Column:
    def by_name(formatted: Column) -> Column:
        def entry(name: Column) -> Column:
            mine = F.filter(formatted, lambda t: t["name"] == name)
            return F.struct(name, F.transform(mine, lambda t: F.struct(
                t["format"].alias("Format"), t["text"].alias("Rendering"))))

        names = F.array_distinct(F.transform(formatted, lambda t: t["name"]))
        return F.when(F.size(formatted) > 0, F.map_from_entries(F.transform(names, entry)))

    return let(F.filter(filled, lambda t: t["format"] != ""), by_name)


def common_templates(events: DataFrame, template: str = "message_template", count: int = COMMON_TEMPLATES) -> list[str]:
    """The templates that most events have, counted over all of them.

    Only a hint for :func:`message_texts`: other templates take the general
    way and give the same result, so the choice never changes an output. The
    count reads one column and sums up before its shuffle; ``count`` rows come back.
    """
    seen = events.where(F.col(template).isNotNull()).groupBy(template).agg(F.count(F.lit(1)).alias("n"))
    return [row[0] for row in seen.orderBy(F.desc("n"), template).limit(count).collect()]


def _own_number(value: Column, fmt: str) -> Column:
    """:func:`formatted_number` for a format known beforehand: only what it needs."""
    def fixed(places: int) -> Column:
        return _rounded(value, places)

    kind, digits = fmt[:1].upper(), fmt[1:]
    if re.fullmatch(r"0+(\.0+)?", fmt):
        whole, _, fraction = fmt.partition(".")
        if len(fraction) > MAX_FRACTION_DIGITS:
            return value
        text = fixed(len(fraction))
        return text if len(whole) == 1 else _padded(text, F.lit(len(whole)))
    if kind in "FN" and re.fullmatch(r"\d?", digits):
        text = fixed(int(digits or 2))
        return text if kind == "F" else _grouped(text)
    if kind == "D" and re.fullmatch(r"\d{0,2}", digits):
        return F.when(_is_whole(value), _padded(fixed(0), F.lit(int(digits or 0))))
    if kind == "P" and re.fullmatch(r"\d?", digits):
        return F.concat(_grouped(_rounded(_percent(value), int(digits or 2))), F.lit(" %"))
    if kind == "E" and re.fullmatch(r"\d?", digits):
        return _exponent(value, F.lit(fmt))
    if kind == "X" and re.fullmatch(r"\d{0,2}", digits):
        return _hexadecimal(value, F.lit(fmt))
    found = re.fullmatch(PATTERN, fmt)
    if found:
        whole, shown, more = (part or "" for part in found.groups())
        if len(shown + more) > MAX_FRACTION_DIGITS:
            return value
        # zeros count from the first one on
        return _patterned(fixed(len(shown + more)), F.lit(len(whole.replace(",", "").lstrip("#"))), F.lit("," in whole), F.lit(len(shown)))
    return value


def formatted(text: Column, fmt: str) -> Column:
    """:func:`formatted_number` under one known format."""
    return F.coalesce(_own_number(text, fmt), text)


def _own_hole(raw: str, properties: Column) -> Column:
    """A hole of a known template, as one compiled expression."""
    name, width, fmt = re.match(HOLE, raw, re.ASCII).groups()
    value = F.try_element_at(properties, F.lit(name))
    text = _plain_text(value)
    if fmt == "l":
        text = _value_text(value, F.lit(fmt))
    elif fmt:
        text = F.when(value.startswith('"'), text).otherwise(formatted(value, fmt))
    if width:
        gap = F.repeat(F.lit(" "), F.lit(abs(int(width))) - F.length(text))
        text = F.concat(gap, text) if int(width) > 0 else F.concat(text, gap)
    return F.coalesce(text, F.lit(raw))


def _own_texts(template: str, properties: Column) -> Column:
    """Message and renderings of a known template."""
    parts, formatted = [], {}
    for raw in re.findall(TOKEN, template, re.ASCII):
        hole = re.match(HOLE, raw, re.ASCII)
        if hole is None:
            parts.append(F.lit({"{{": "{", "}}": "}"}.get(raw, raw)))
            continue
        text = _own_hole(raw, properties)
        parts.append(text)
        if hole.group(3):
            row = F.concat(F.lit(f'{{"Format":{json.dumps(hole.group(3), ensure_ascii=False)},"Rendering":'), string_json(text), F.lit("}"))
            formatted.setdefault(hole.group(1), []).append(row)
    members = [F.concat(F.lit(f"{json.dumps(name)}:["), F.concat_ws(",", *rows), F.lit("]")) for name, rows in formatted.items()]
    renderings = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")) if members else F.lit(None).cast("string")
    message = F.concat(*parts) if parts else F.lit("")
    return F.struct(message.alias("message"), renderings.alias("renderings"))


def message_texts(template: Column, properties: Column, common: Sequence[str] = ()) -> Column:
    """``struct<message, renderings>``: the message and the formatted tokens as JSON (null without any).

    Every template in ``common`` becomes its own compiled expression; lambdas
    over token arrays, which Spark interprets, are left for the rest.
    """
    general = let(rendered_tokens(template, properties), lambda filled: F.struct(
        _message(filled).alias("message"), F.to_json(_renderings(filled)).alias("renderings")))
    if not common:
        return general
    chosen = F.when(template == common[0], _own_texts(common[0], properties))
    for one in common[1:]:
        chosen = chosen.when(template == one, _own_texts(one, properties))
    return chosen.otherwise(general)


def rendered_message(template: Column, properties: Column) -> Column:
    """The message text of an event."""
    return _message(rendered_tokens(template, properties))


def renderings(template: Column, properties: Column) -> Column:
    """Formatted tokens by property, as ``map<name, array<struct<Format, Rendering>>>``; null without any."""
    return _renderings(rendered_tokens(template, properties))
