"""Normalisers, predicates and small generators as Column -> Column functions. All run inside codegen."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats of dates: a pattern that guards each, so that nothing lenient slips through.
COMPACT, DASHED, SLASHED = "yyyyMMdd", "yyyy-M-d", "yyyy/M/d"
_GUARD = {COMPACT: r"^\d{8}$", DASHED: r"^\d{4}-\d{1,2}-\d{1,2}$", SLASHED: r"^\d{4}/\d{1,2}/\d{1,2}$"}
DATE_FORMATS = (COMPACT, DASHED, SLASHED)
_SPACE = r"[\s\x1c-\x1f\x{85}\p{Z}]"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def trim(c: Column) -> Column:
    """Without leading and trailing white space of any script and control separators."""
    return F.regexp_replace(c, rf"^{_SPACE}+|{_SPACE}+$", "")


def text_or_null(c: Column) -> Column:
    """Trimmed; blank becomes null."""
    return F.nullif(trim(c), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only values."""
    return text_or_null(c).isNull()


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first format that fits; null if none does. Compact dates need eight digits; separated ones may omit zeros."""
    v = trim(c)
    tries = [F.when(v.rlike(_GUARD[f]), F.try_to_timestamp(v, F.lit(f)).cast("date")) for f in formats]
    return F.coalesce(*tries)


def date_quality(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """VALID, MISSING (null or blank) or INVALID."""
    return F.when(is_blank(c), "MISSING").when(parse_date(c, formats).isNull(), "INVALID").otherwise("VALID")


def date_format_id(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Name of the first format that fits a value, or null."""
    out = F.lit(None).cast("string")
    for f in reversed(formats):
        out = F.when(parse_date(c, [f]).isNotNull(), f).otherwise(out)
    return out


def parse_float(c: Column) -> Column:
    """A finite double from plain decimal or exponent notation; null for blank, anything else and overflow."""
    v = trim(c)
    number = F.when(v.rlike(_NUMBER), v.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def float_is_bad(c: Column) -> Column:
    """A value is present and isn't a finite number: where strict transforms must fail."""
    return ~is_blank(c) & parse_float(c).isNull()


def parse_instant(c: Column) -> Column:
    """ISO-8601 with an offset or Z to an instant; null without an offset or if malformed."""
    v = trim(c)
    stamped = v.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(stamped, F.try_to_timestamp(F.regexp_replace(F.regexp_replace(v, "T", " "), r"([+-]\d{2})(\d{2})$", "$1:$2")))


def local_date(instant: Column, zone: str = "Asia/Seoul") -> Column:
    """The calendar date of an instant in a zone."""
    return F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(instant, F.current_timezone()), zone))


def first_filled(*columns: Column) -> Column:
    """The first column that isn't null or empty, else the last."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])


def first_token(c: Column, separator: str = " ") -> Column:
    return F.element_at(F.split(c, separator), 1)


def mapped(c: Column, labels: Mapping[str, str]) -> Column:
    """Label of a value by dictionary; null for unknown values."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), c)


def prefix_class(c: Column, classes: Mapping[str, Sequence[str]]) -> Column:
    """The first class of which a prefix starts the value; null if none does."""
    out = F.lit(None).cast("string")
    for name, prefixes in reversed(classes.items()):
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | c.startswith(p)
        out = F.when(hit, name).otherwise(out)
    return out


def in_box(lon: Column, lat: Column, west: float, south: float, east: float, north: float) -> Column:
    """Inside the box, edges included; false for null and non-finite coordinates."""
    return F.coalesce(~F.isnan(lon) & ~F.isnan(lat) & lon.between(west, east) & lat.between(south, north), F.lit(False))


#: Formats of identifiers.
FORMATS = {"sha256": r"^[0-9a-f]{64}$", "code7": r"^[0-9]{7}$", "code7_or_all": r"^([0-9]{7}|[0-9]{7}_ALL)$", "build_id": r"^[0-9a-f]{16}$", "slug": r"^[a-z0-9](?:[a-z0-9-]{0,48}[a-z0-9])?$"}


def has_format(c: Column, name: str) -> Column:
    return F.coalesce(c.rlike(FORMATS[name]), F.lit(False))


#: Query keys whose values are secrets.
SECRET_KEYS = ("servicekey", "apikey", "api_key", "key", "token", "access_token", "secret", "password", "ref")


def redact_url(url: Column, secrets: Sequence[str] = SECRET_KEYS) -> Column:
    """The url with the values of secret query keys replaced by REDACTED; null if it carries a user or password."""
    head, query = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(#.*)$", 1)
    pair = lambda kv: F.when(F.lower(F.split(kv, "=", 2)[0]).isin(*secrets), F.concat(F.split(kv, "=", 2)[0], F.lit("=REDACTED"))).otherwise(kv)
    clean = F.array_join(F.transform(F.split(query, "&"), pair), "&")
    whole = F.concat(head, F.when(query == "", "").otherwise(F.concat(F.lit("?"), clean)), fragment)
    return F.when(~url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*@"), whole)


def url_allowed(url: Column, hosts: Sequence[str]) -> Column:
    """https, an allowed host, no user, and not an error page."""
    host = F.lower(F.regexp_extract(url, r"^https://([^/?#:@]*)(:\d+)?(?:[/?#]|$)", 1))
    path = F.lower(F.regexp_extract(url, r"^https://[^/?#]*([^?#]*)", 1))
    return F.coalesce(host.isin(*hosts) & ~path.endswith("/error.html") & ~path.contains("/error/"), F.lit(False))


def row_hash(*fields: Column) -> Column:
    """SHA-256 over each field's eight-byte big-endian length and its UTF-8 bytes; null counts as empty."""
    parts = []
    for c in fields:
        v = F.coalesce(c.cast("string"), F.lit(""))
        parts += [F.unhex(F.lpad(F.hex(F.octet_length(v).cast("long")), 16, "0")), F.encode(v, "UTF-8")]
    return F.sha2(F.concat(*parts), 256)


def hash_bucket(c: Column) -> Column:
    """The first byte of the SHA-256 of a text: 0 to 255."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 2), 16, 10).cast("int")


def composite_key(*parts: Column) -> Column:
    """Trimmed parts joined by U+001F; null if any is blank."""
    clean = [text_or_null(p) for p in parts]
    filled = clean[0].isNotNull()
    for p in clean[1:]:
        filled = filled & p.isNotNull()
    return F.when(filled, F.concat_ws("\x1f", *clean))


def percent(n: Column, d: Column, digits: int = 6) -> Column:
    """100 n / d, rounded; null if d is 0."""
    return F.round(F.lit(100.0) * n / F.nullif(d, F.lit(0)), digits)


def percent_text(n: Column, d: Column) -> Column:
    """'12.3%'; '0.0%' if d is 0."""
    return F.concat(F.format_number(F.coalesce(F.round(100.0 * n / F.nullif(d, F.lit(0)), 1), F.lit(0.0)), "0.0"), F.lit("%"))


def month_cycle(month: Column) -> tuple[Column, Column]:
    """Sine and cosine of the month after a date's, on a circle of twelve."""
    angle = F.lit(2.0) * F.pi() * F.month(F.add_months(month, 1)) / 12
    return F.sin(angle), F.cos(angle)


def clip_low(c: Column, low: float = 0.0) -> Column:
    """max(c, low); null stays null."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


#: Words in a column's name and the class they hint at.
NAME_HINTS = {
    "date": ("date", "일자", "시점", "ymd"),
    "status": ("status", "state", "상태", "stts"),
    "address": ("address", "addr", "주소"),
    "identifier": ("key", "id", "code", "number", "번호", "코드", "no"),
    "coordinate": ("coordinate", "좌표", "lon", "lat", "crd"),
}


def name_hints(columns: Sequence[str]) -> dict[str, list[str]]:
    """The columns of each class, by words in their names."""
    return {kind: [c for c in columns if any(w in c.lower() for w in words)] for kind, words in NAME_HINTS.items()}
