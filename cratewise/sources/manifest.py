"""Layout of the tables in a catalogue dump."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    position: int


@dataclass(frozen=True)
class TableSpec:
    """One dump table: its file, all its columns by position, and those kept on load."""

    name: str
    file_name: str
    columns: tuple[Column, ...]
    keep: tuple[str, ...]

    def __post_init__(self) -> None:
        positions = sorted(c.position for c in self.columns)
        if positions != list(range(len(positions))):
            raise ValueError(f"column positions of {self.name!r} must be 0..n-1, got {positions}")
        unknown = set(self.keep) - {c.name for c in self.columns}
        if unknown:
            raise ValueError(f"{self.name!r} keeps undeclared columns {sorted(unknown)}")

    @classmethod
    def from_ddl(
        cls, name: str, ddl: str, keep: Sequence[str] = (), file_name: str | None = None
    ) -> TableSpec:
        """Spec from a DDL column list in file order; an empty ``keep`` keeps every column."""
        fields = T.StructType.fromDDL(ddl).fields
        columns = tuple(Column(f.name, f.dataType, i) for i, f in enumerate(fields))
        return cls(name, file_name or name, columns, tuple(keep) or tuple(f.name for f in fields))

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def schema(self, keep: Sequence[str] | None = None) -> T.StructType:
        kept = self.keep if keep is None else keep
        return T.StructType([T.StructField(n, self.column(n).dtype) for n in kept])


# Column order and types of the dump files, and the columns the build reads.
_LAYOUT = {
    "artist": (
        "id INT, gid STRING, name STRING, sort_name STRING, begin_date_year INT, "
        "begin_date_month INT, begin_date_day INT, end_date_year INT, end_date_month INT, "
        "end_date_day INT, type INT, area INT, gender INT, comment STRING, edits_pending INT, "
        "last_updated STRING, ended BOOLEAN, begin_area INT, end_area INT",
        ["id", "gid", "name"],
    ),
    "artist_credit_name": (
        "artist_credit INT, position INT, artist INT, name STRING, join_phrase STRING",
        ["artist_credit", "position", "artist", "name"],
    ),
    "recording": (
        "id INT, gid STRING, name STRING, artist_credit INT, length INT, comment STRING, "
        "edits_pending INT, last_updated STRING, video INT",
        ["id", "gid", "name", "artist_credit", "length"],
    ),
    "track": (
        "id INT, gid STRING, recording INT, medium INT, position INT, number STRING, name STRING, "
        "artist_credit INT, length INT, edits_pending INT, last_updated STRING, is_data_track INT",
        ["id", "recording", "medium", "name"],
    ),
    "medium": (
        "id INT, release INT, position INT, format INT, name STRING, edits_pending INT, "
        "last_updated STRING, track_count INT, gid STRING",
        ["id", "release"],
    ),
    "release": (
        "id INT, gid STRING, name STRING, artist_credit INT, release_group INT, status INT, "
        "packaging INT, language INT, script INT, barcode STRING, comment STRING, "
        "edits_pending INT, quality INT, last_updated STRING",
        ["id", "name", "artist_credit", "release_group", "status"],
    ),
    "release_group": (
        "id INT, gid STRING, name STRING, artist_credit INT, type INT, comment STRING, "
        "edits_pending INT, last_updated STRING",
        ["id", "gid", "name", "artist_credit", "type"],
    ),
    "release_country": (
        "release INT, country INT, date_year INT, date_month INT, date_day INT",
        ["release", "date_year", "date_month", "date_day"],
    ),
    "release_unknown_country": (
        "release INT, date_year INT, date_month INT, date_day INT",
        ["release", "date_year", "date_month", "date_day"],
    ),
    "url": (
        "id INT, gid STRING, url STRING, edits_pending INT, last_updated STRING",
        ["id", "url"],
    ),
    "l_recording_url": (
        "id INT, link INT, entity0 INT, entity1 INT, edits_pending INT, last_updated STRING, "
        "link_order INT",
        ["entity0", "entity1"],
    ),
    "l_artist_url": (
        "id INT, link INT, entity0 INT, entity1 INT, edits_pending INT, last_updated STRING, "
        "link_order INT",
        ["entity0", "entity1"],
    ),
    "rg_type": (
        "id INT, name STRING, parent INT, child_order INT, description STRING, gid STRING",
        ["id", "name"],
    ),
}
_FILE_NAMES = {"rg_type": "release_group_primary_type"}


def catalogue_manifest() -> Mapping[str, TableSpec]:
    """Specs of the thirteen dump tables, by table name."""
    return {
        name: TableSpec.from_ddl(name, ddl, keep, _FILE_NAMES.get(name))
        for name, (ddl, keep) in _LAYOUT.items()
    }
