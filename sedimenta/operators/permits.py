"""Source rows of permits to the typed parent, its geographic sidecar and its episodes, and the contracts of all three."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import scalars as S
from sedimenta.operators.contract import ColumnRule, Contract, ContractError, Invariant
from sedimenta.operators.episodes import EPISODE_INVARIANTS, QUALITIES
from sedimenta.operators.geo import COUNTRY_BOX, MODIFIED_CENTRAL_BELT, Transform, with_geographic

# Names of the source's columns, those that the parent keeps by their new names, and those that it leaves out.
TEXTS = {
    "authority_code": "개방자치단체코드",
    "management_number": "관리번호",
    "source_status_code": "영업상태코드",
    "source_status_name": "영업상태명",
    "source_detail_status_code": "상세영업상태코드",
    "source_detail_status_name": "상세영업상태명",
    "business_name": "사업장명",
    "business_type_name": "업태구분명",
    "hygiene_business_type_name": "위생업태명",
    "lot_postal_code": "소재지우편번호",
    "road_postal_code": "도로명우편번호",
    "lot_address": "지번주소",
    "road_address": "도로명주소",
    "source_data_update_type": "데이터갱신구분",
    "source_data_updated_at_raw": "데이터갱신시점",
    "source_last_modified_at_raw": "최종수정시점",
}
DATES = {"permit_date": "인허가일자", "closure_date": "폐업일자"}
NUMBERS = {"source_coordinate_x": "좌표정보(X)", "source_coordinate_y": "좌표정보(Y)"}
REQUIRED = ("authority_code", "management_number")
LEFT_OUT = (
    "소재지면적", "건물소유구분명", "공장사무직직원수", "공장생산직직원수", "공장판매직직원수", "급수시설구분명", "남성종사자수", "다중이용업소여부", "등급구분명", "보증액",
    "본사직원수", "시설총규모", "여성종사자수", "영업장주변구분명", "월세액", "전통업소주된음식", "전통업소지정번호", "전화번호", "홈페이지",
)
SOURCE_COLUMNS = (*TEXTS.values(), *DATES.values(), *NUMBERS.values(), *LEFT_OUT)

_quality = lambda name: ColumnRule(name, "string", False, QUALITIES)
_texts = lambda *names: tuple(ColumnRule(n, "string") for n in names)
_STATUS = ("source_status_code", "source_status_name", "source_detail_status_code", "source_detail_status_name")

PARENT = Contract(
    "permit_parent",
    (
        ColumnRule("source_key", "string", False),
        ColumnRule("source_row_number", "bigint", False),
        ColumnRule("source_artifact_sha256", "string", False),
        ColumnRule("source_retrieved_at_utc", "timestamp", False),
        ColumnRule("authority_code", "string", False),
        ColumnRule("management_number", "string", False),
        ColumnRule("permit_date", "date"),
        _quality("permit_date_quality"),
        *_texts(*_STATUS),
        ColumnRule("closure_date", "date"),
        _quality("closure_date_quality"),
        *_texts("business_name", "business_type_name", "hygiene_business_type_name", "lot_postal_code", "road_postal_code", "lot_address", "road_address"),
        ColumnRule("source_coordinate_x", "double"),
        ColumnRule("source_coordinate_y", "double"),
        *_texts("source_data_update_type", "source_data_updated_at_raw", "source_last_modified_at_raw"),
    ),
    (
        Invariant("row numbers start at 1", "source_row_number >= 1"),
        Invariant("digests are SHA-256", f"source_artifact_sha256 RLIKE '{S.FORMATS['sha256']}'"),
        Invariant("permit dates fit their quality", "(permit_date_quality = 'VALID') = (permit_date IS NOT NULL)"),
        Invariant("closure dates fit their quality", "(closure_date_quality = 'VALID') = (closure_date IS NOT NULL)"),
    ),
    ("establishment_id", "canonical_active_flag", "canonical_closed_flag", "terminal_event_flag", "physical_open_date", "wgs84_latitude", "wgs84_longitude"),
)

_WEST, _SOUTH, _EAST, _NORTH = COUNTRY_BOX
SIDECAR = Contract(
    "permit_geospatial",
    (
        ColumnRule("source_key", "string", False),
        ColumnRule("source_row_number", "bigint", False),
        ColumnRule("management_number", "string", False),
        ColumnRule("parent_permit_build_id", "string", False),
        ColumnRule("wgs84_longitude", "double"),
        ColumnRule("wgs84_latitude", "double"),
        ColumnRule("coordinate_quality", "string", False, ("TRANSFORMED", "MISSING_SOURCE_COORDINATES")),
    ),
    (
        Invariant("transformed pairs are inside", f"coordinate_quality <> 'TRANSFORMED' OR (wgs84_longitude BETWEEN {_WEST} AND {_EAST} AND wgs84_latitude BETWEEN {_SOUTH} AND {_NORTH})"),
        Invariant("missing pairs are null", "coordinate_quality <> 'MISSING_SOURCE_COORDINATES' OR (wgs84_longitude IS NULL AND wgs84_latitude IS NULL)"),
    ),
    ("business_name", "road_address", "lot_address", "telephone_number", "canonical_active_flag", "canonical_closed_flag", "terminal_event_flag"),
)

EPISODE = Contract(
    "permit_status_episode",
    (
        ColumnRule("source_key", "string", False),
        ColumnRule("management_number", "string", False),
        ColumnRule("episode_number", "int", False),
        *(ColumnRule(n, "date", False) for n in ("observation_window_start_date", "observation_window_end_date", "first_observed_date", "last_observed_date")),
        ColumnRule("observation_count", "int", False),
        *_texts(*_STATUS),
        ColumnRule("start_boundary_lower_date", "date"),
        ColumnRule("start_boundary_upper_date", "date", False),
        ColumnRule("start_censoring", "string", False, ("LEFT_CENSORED", "INTERVAL_CENSORED")),
        ColumnRule("end_boundary_lower_date", "date", False),
        ColumnRule("end_boundary_upper_date", "date"),
        ColumnRule("end_censoring", "string", False, ("INTERVAL_CENSORED", "RIGHT_CENSORED")),
        ColumnRule("right_censored", "boolean", False),
        ColumnRule("source_closure_date_first_observed", "date"),
        _quality("source_closure_date_first_quality"),
        ColumnRule("source_closure_date_last_observed", "date"),
        _quality("source_closure_date_last_quality"),
    ),
    EPISODE_INVARIANTS,
    ("establishment_id", "episode_id", "canonical_active_flag", "canonical_closed_flag", "terminal_event_flag", "event_date", "exact_open_date", "exact_close_date", "reopened_flag", "duration_days"),
)


class PermitError(ValueError):
    """A source frame isn't of the shape that the transform takes."""


@dataclass(frozen=True)
class Lineage:
    """Where rows come from. Texts hold for all rows and are checked at once; columns are checked row by row."""

    source_key: str | Column
    artifact_sha256: str | Column
    retrieved_at: str | datetime | Column

    def columns(self) -> dict[str, Column]:
        instant = self.retrieved_at
        if isinstance(instant, datetime):
            if instant.tzinfo is None:
                raise PermitError("the time of retrieval needs a zone")
            instant = instant.isoformat()
        if isinstance(instant, str):
            try:
                zoned = datetime.fromisoformat(instant.strip()).tzinfo is not None
            except ValueError as error:
                raise PermitError(f"no ISO-8601 instant: {instant!r}") from error
            if not zoned:
                raise PermitError("the time of retrieval needs a zone")
            instant = F.lit(instant.strip())
        if isinstance(self.artifact_sha256, str) and not (len(self.artifact_sha256) == 64 and set(self.artifact_sha256) <= set("0123456789abcdef")):
            raise PermitError("a digest has 64 lower-case hexadecimal digits")
        key, digest = (F.lit(v) if isinstance(v, str) else v for v in (self.source_key, self.artifact_sha256))
        return {"source_key": key, "source_artifact_sha256": digest, "source_retrieved_at_utc": S.parse_instant(instant)}


def require_source_shape(columns: Sequence[str], beside: Sequence[str]) -> None:
    """Raises PermitError unless the columns are those of the source and those beside it, each once and in any order."""
    wanted = (*SOURCE_COLUMNS, *beside)
    missing, extra = set(wanted) - set(columns), set(columns) - set(wanted)
    if missing or extra or len(columns) != len(set(wanted)):
        raise PermitError(f"not the source's {len(SOURCE_COLUMNS)} columns and {list(beside)}; missing {sorted(missing)}, unknown {sorted(extra)}")


def _faults(source: dict[str, Column]) -> dict[str, Column]:
    """What the parent can't hold, by name: blank identifiers and coordinates that aren't finite numbers."""
    blank = {f"{c} is blank": S.is_blank(source[c]) for c in REQUIRED}
    return blank | {f"{c} is no finite number": S.float_is_bad(source[c]) for c in NUMBERS}


def _fields() -> dict[str, Column]:
    return {name: F.col(f"`{source}`") for name, source in (TEXTS | DATES | NUMBERS).items()}


def parent_rows(df: DataFrame, lineage: Lineage, row_number: str = "source_row_number", faulty: str = "raise", carried: Sequence[str] = ()) -> DataFrame:
    """The parent's 26 columns from the source's 39 and a row number: one projection, no shuffle.

    Texts are trimmed, blank ones null; unreadable dates are null with quality INVALID. Rows that the parent can't hold
    (see rejected_rows) raise while the frame is computed; faulty="drop" leaves them out, faulty="null" keeps them
    with nulls, for profiles only. carried: columns beside the source's that the lineage refers to.
    """
    if faulty not in ("raise", "drop", "null"):
        raise ValueError("faulty is 'raise', 'drop' or 'null'")
    require_source_shape(df.columns, (row_number, *carried))
    fields, origin = _fields(), lineage.columns()
    wrong = _faults(fields) | {"the lineage is incomplete": origin["source_key"].isNull() | origin["source_retrieved_at_utc"].isNull() | ~S.has_format(origin["source_artifact_sha256"], "sha256"), "the row number is below 1": ~F.coalesce(F.col(row_number) >= 1, F.lit(False))}
    if faulty == "drop":
        for bad in wrong.values():
            df = df.where(~bad)
    out = {**origin, "source_row_number": F.col(row_number).cast("bigint")}
    out |= {name: S.text_or_null(fields[name]) for name in TEXTS} | {name: S.parse_float(fields[name]) for name in NUMBERS}
    for name in DATES:
        out |= {name: S.parse_date(fields[name]), f"{name}_quality": S.date_quality(fields[name])}
    if faulty == "raise":
        stop = F.lit(None).cast("string")
        for why, bad in wrong.items():
            stop = F.when(bad, F.raise_error(F.lit(why))).otherwise(stop)
        out["source_key"] = F.coalesce(stop, out["source_key"])
    return df.select(*[out[c.name].alias(c.name) for c in PARENT.columns])


def rejected_rows(df: DataFrame, row_number: str = "source_row_number", carried: Sequence[str] = ()) -> DataFrame:
    """(row_number, reasons): the rows whose identifiers are blank or whose coordinates are no finite numbers."""
    require_source_shape(df.columns, (row_number, *carried))
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(why)) for why, bad in _faults(_fields()).items()]))
    return df.select(row_number, reasons.alias("reasons")).where(F.size("reasons") > 0)


def require_one_each(parent: DataFrame) -> DataFrame:
    """The parent, which raises while it is computed if a source holds a management number twice. One shuffle, no second pass over the source.

    The rows of a number that comes often are not gathered: numbers are counted first (with partial sums), and only a
    number that is repeated raises.
    """
    keys = ("source_key", "management_number")
    counts = parent.groupBy(*keys).agg(F.count("*").alias("n"))
    again = F.raise_error(F.concat_ws(" ", F.lit("repeated management number in"), F.col("source_key"))).cast("boolean")
    worst = counts.select(F.when(F.col("n") > 1, again).otherwise(F.lit(True)).alias("once")).agg(F.bool_and("once").alias("__once"))
    return parent.crossJoin(F.broadcast(worst)).where(F.coalesce("__once", F.lit(True))).drop("__once")  # one row


def sidecar_rows(parent: DataFrame, build_id: str, transform: Transform = MODIFIED_CENTRAL_BELT.to_wgs84) -> DataFrame:
    """The sidecar's seven columns: one row for each row of the parent, whose build it names."""
    placed = with_geographic(parent, "source_coordinate_x", "source_coordinate_y", transform)
    return placed.withColumn("parent_permit_build_id", F.lit(build_id)).select(*[c.name for c in SIDECAR.columns])


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns, in order and cast to its types (a value that doesn't fit raises); unknown columns are left out."""
    missing = [c.name for c in contract.columns if c.name not in df.columns]
    if missing:
        raise ContractError(f"columns {missing} are missing")
    return df.select(*[F.col(c.name).cast(c.kind).alias(c.name) for c in contract.columns])
