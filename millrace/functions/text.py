"""Text functions used on the data path, all JVM-side column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

_FIELD = re.compile(r"\{(.*?)\}")

# The four date layouts a template may name, each with the shape of
# the text prefix that is read and what completes it to seconds.
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
DATE_LAYOUTS = {
    "yyyy-MM-dd": (rf"^({_DAY})", " 0:0:0"),
    "yyyy-MM-dd HH": (rf"^({_DAY} \d{{1,2}})", ":0:0"),
    "yyyy-MM-dd HH:mm": (rf"^({_DAY} \d{{1,2}}:\d{{1,2}})", ":0"),
    "yyyy-MM-dd HH:mm:ss": (rf"^({_DAY} \d{{1,2}}:\d{{1,2}}:\d{{1,2}})", ""),
}


def undock(text: str) -> str:
    """``{a}`` -> ``a``; any other text unchanged."""
    return text[1:-1] if text.startswith("{") and text.endswith("}") else text


def field(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def nonempty(c: Column) -> Column:
    """null for "" as well as for null (string columns)."""
    return F.when(c != F.lit(""), c)


def full_match(c: Column, pattern: str) -> Column:
    """True when the whole value matches (``$`` would also accept a final newline)."""
    return c.rlike(rf"\A(?:{pattern})\z")


def reformat_date(c: Column, layout: str, dtype: T.DataType) -> Column:
    """Date text in one of the four layouts.

    A text value is read by its leading part, later text is ignored; blank or
    unreadable values and unknown layouts give "".  Out-of-range parts (month
    13) give "" as well: they are not rolled over into the next year.
    """
    layout = layout.strip()
    if layout not in DATE_LAYOUTS:
        return F.when(c.isNotNull(), F.lit(""))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.date_format(c, layout)
    shape, rest = DATE_LAYOUTS[layout]
    head = nonempty(F.regexp_extract(F.trim(c.cast("string")), shape, 1))
    # without time zone: no hour is skipped or doubled by a clock change
    parsed = F.concat(head, F.lit(rest)).try_cast("timestamp_ntz")
    return F.when(c.isNotNull(), F.coalesce(F.date_format(parsed, layout), F.lit("")))


def template(text: str, schema: T.StructType) -> Column:
    """``tj-{sid}-{stime, yyyy-MM-dd}`` as one string column.

    A field that is unknown, or null in a row, keeps its literal ``{...}`` text.
    """
    types = {f.name.lower(): f.dataType for f in schema.fields}
    parts: list[Column] = []
    end = 0
    for m in _FIELD.finditer(text):
        if m.start() > end:
            parts.append(F.lit(text[end:m.start()]))
        end = m.end()
        name, _, layout = m.group(1).partition(",")
        dtype = types.get(name.lower())
        literal = F.lit(m.group(0))
        if dtype is None:
            parts.append(literal)
        elif layout:
            parts.append(F.coalesce(reformat_date(field(name), layout, dtype), literal))
        else:
            parts.append(F.coalesce(field(name).cast("string"), literal))
    if end < len(text):
        parts.append(F.lit(text[end:]))
    return F.concat(*parts) if parts else F.lit("")


def template_fields(text: str) -> list[str]:
    return [m.group(1).split(",")[0] for m in _FIELD.finditer(text)]


def expand_timestamp(c: Column) -> Column:
    """``20150417`` -> ``2015-04-17 00:00:00``: digits padded with zeros to 14.

    Non-digits and more than 14 digits give null.  Four or six digits would
    name month or day 00 and give null; they are not rolled back.
    """
    digits = F.when(c.rlike(r"\A[0-9]{1,14}\z"), F.rpad(c, 14, "0"))
    text = F.regexp_replace(digits, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")
    return F.when(text.try_cast("timestamp_ntz").isNotNull(), text)


def iso_datetime(c: Column) -> Column:
    """``2015-04-17T02:00:00+08:00`` -> ``2015-04-17 02:00:00``, offset dropped; null if absent."""
    shape = r"\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}"
    return F.replace(nonempty(F.regexp_extract(c, f"({shape})", 1)), F.lit("T"), F.lit(" "))


def from_millis(c: Column, layout: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Milliseconds since 1970 as date text in the session time zone."""
    return F.date_format(F.timestamp_millis(c.cast("bigint")), layout)


def to_millis(c: Column, layout: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Date text as milliseconds since 1970; null when it does not fit the layout."""
    return F.unix_millis(F.try_to_timestamp(c, F.lit(layout)))


def bracketed(c: Column, opening: str, closing: str) -> Column:
    """Text between a leading and a trailing one-character mark, else null."""
    return F.when(
        c.startswith(opening) & c.endswith(closing) & (F.length(c) >= 2),
        F.substring(c, F.lit(2), F.length(c) - 2),
    )


def pairs_to_map(c: Column, pair_sep: str = ",", key_sep: str = ":") -> Column:
    """``k:v,k:v`` -> map; malformed pairs are skipped, the last of equal keys wins."""
    halves = F.transform(F.split(c, re.escape(pair_sep)), lambda p: F.split(p, re.escape(key_sep)))
    good = F.filter(halves, lambda h: F.size(h) == 2)
    last = F.filter(
        good,
        lambda h, i: ~F.exists(F.slice(good, i + 2, F.size(good)), lambda o: o[0] == h[0]),
    )
    return F.map_from_entries(F.transform(last, lambda h: F.struct(h[0].alias("k"), h[1].alias("v"))))


def pad_left(c: Column, width: int, fill: str = " ") -> Column:
    """Trimmed value filled on the left; longer values are kept whole, null counts as ""."""
    s = F.coalesce(F.trim(c.cast("string")), F.lit(""))
    return F.when(F.length(s) < width, F.lpad(s, width, fill)).otherwise(s)


def pad_right(c: Column, width: int, fill: str = " ") -> Column:
    s = F.coalesce(F.trim(c.cast("string")), F.lit(""))
    return F.when(F.length(s) < width, F.rpad(s, width, fill)).otherwise(s)


def replace_chars(c: Column, search: str, replacement: str) -> Column:
    """Character by character; characters without a counterpart are deleted."""
    return F.translate(c, search, replacement)


def replace_once(c: Column, search: str, replacement: str) -> Column:
    at = F.instr(c, search)
    return F.when(
        at > 0,
        F.concat(F.substring(c, F.lit(1), at - 1), F.lit(replacement), F.substring(c, at + len(search), F.length(c))),
    ).otherwise(c)


def count_char(c: Column, ch: str) -> Column:
    c = F.coalesce(c, F.lit(""))
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def file_name(path: Column) -> Column:
    """Last path segment; "" when there is no slash, null for a blank path."""
    named = F.when(F.instr(path, "/") > 0, F.substring_index(path, "/", -1)).otherwise(F.lit(""))
    return F.when(F.length(F.trim(path)) > 0, named)


def parent_path(path: Column) -> Column:
    """Folder part without a final slash; "/" for a top-level entry, null for a blank path."""
    trimmed = F.regexp_replace(path, r"/+\z", "")
    parent = F.regexp_extract(trimmed, r"(?s)\A(.*)/[^/]*\z", 1)
    return F.when(
        F.length(F.trim(path)) > 0,
        F.when((parent == "") & path.startswith("/"), F.lit("/")).otherwise(parent),
    )


def compression_of(path: Column) -> Column:
    """TARGZ, TAR, GZ or NONE by suffix, in any letter case."""
    low = F.lower(path)
    return (
        F.when(low.endswith(".tar.gz"), F.lit("TARGZ"))
        .when(low.endswith(".tar"), F.lit("TAR"))
        .when(low.endswith(".gz"), F.lit("GZ"))
        .otherwise(F.lit("NONE"))
    )


def file_id(source_id: int, path: Column) -> Column:
    """Identity of a source file: source id followed by the md5 of source id and path.

    The digest is the usual zero-padded unsigned hex text.
    """
    head = F.lit(str(source_id))
    return F.concat(head, F.md5(F.concat(head, path)))


def digest(c: Column, kind: str = "md5") -> Column:
    """Hex digest: md5, sha1, sha224, sha256, sha384 or sha512."""
    if kind == "md5":
        return F.md5(c)
    if kind == "sha1":
        return F.sha1(c)
    return F.sha2(c, int(kind.removeprefix("sha")))


def renamed(path: Column, rename: str, rule: str | None = None) -> Column:
    """Target file name from ``{SF_NAME}`` and ``$0``, ``$1`` ... (n-th match of ``rule``).

    A ``$n`` beyond the number of matches keeps its text.
    """
    name = F.substring_index(path, "/", -1)
    out: Column = F.lit(rename)
    for spelling in sorted(set(re.findall(r"\{SF_NAME\}", rename, flags=re.I))):
        out = F.replace(out, F.lit(spelling), name)
    if rule:
        found = F.regexp_extract_all(name, F.lit(f"({rule})"), F.lit(1))
        for n in sorted({int(x) for x in re.findall(r"\$(\d)", rename)}):
            out = F.replace(out, F.lit(f"${n}"), F.coalesce(F.get(found, F.lit(n)), F.lit(f"${n}")))
    return out
