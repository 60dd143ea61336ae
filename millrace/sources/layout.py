"""Fixed-width layouts: ordered field names and widths."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import accumulate
from pathlib import Path

from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    fields: tuple[tuple[str, int], ...]

    @classmethod
    def of(cls, fields: Iterable[tuple[str, int]]) -> Layout:
        return cls(tuple((name, int(width)) for name, width in fields))

    @classmethod
    def from_json(cls, path: str | Path) -> Layout:
        """A layout of any width from a JSON object `{name: width, ...}`."""
        return cls.of(json.loads(Path(path).read_text()).items())

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def widths(self) -> list[int]:
        return [width for _, width in self.fields]

    @property
    def length(self) -> int:
        return sum(self.widths)

    @property
    def starts(self) -> list[int]:
        return [0, *accumulate(self.widths)][:-1]

    def ending_at(self, offsets: Iterable[int]) -> list[str]:
        """Names of the fields whose end offset is listed."""
        wanted = set(offsets)
        return [n for n, end in zip(self.names, accumulate(self.widths)) if end in wanted]

    def schema(self, date_columns: Sequence[str] = ()) -> T.StructType:
        """Table schema: varchar(width), or date for the named columns (case matters)."""
        return T.StructType(
            [
                T.StructField(name, T.DateType() if name in date_columns else T.VarcharType(width))
                for name, width in self.fields
            ]
        )

    def ddl(self, date_columns: Sequence[str] = ()) -> str:
        return ", ".join(
            f"`{name}` date" if name in date_columns else f"`{name}` varchar({width})"
            for name, width in self.fields
        )


# The 16 fields of a consumer request line (220 characters).
REQUEST_LAYOUT = Layout.of(
    [
        ("reference_number", 12),
        ("last_name", 25),
        ("first_name", 15),
        ("middle_name", 10),
        ("suffix", 2),
        ("filler1", 15),
        ("sin", 9),
        ("date_of_birth", 6),
        ("civic_line", 30),
        ("city", 20),
        ("province_code", 2),
        ("postal_code", 6),
        ("file_number", 10),
        ("filler2", 8),
        ("applicant_guid", 25),
        ("reserved", 25),
    ]
)

# The leading fields of a consumer response line. The scored
# attributes that follow are a parameter: load the full layout from JSON.
RESPONSE_HEAD = Layout.of(
    [
        ("customer_reference_number", 12),
        ("last_name", 25),
        ("first_name", 15),
        ("middle_name", 10),
        ("suffix", 2),
        ("filler_1", 15),
        ("sin", 9),
        ("dob_text", 6),
        ("address", 30),
        ("city", 20),
        ("province", 2),
        ("postal_code", 6),
        ("unique_number", 10),
        ("filler_2", 8),
        ("applicant_guid", 20),
        ("filler_3", 5),
    ]
)

# End offsets of the fields that identify a person.
PERSONAL_END_OFFSETS = (37, 52, 62, 88, 94, 124, 144, 146, 152)

# The date fields of a full consumer response line.
RESPONSE_DATE_COLUMNS = (
    "DOB_TEXT", "PRXX014", "PRXX016", "PRXX039", "PRXX044", "INQAL009", "INQAM009",
    "INQMG009", "INQBK009", "INQCU009", "INQNC009", "INQAF009", "INQPF009", "INQSF009",
    "INQRT009", "INQRD009", "INQTE009", "INQBD009", "INQCL009",
)

# The first and last line of a bureau file.
HEADER_PREFIX = "BHDR-EQUIFAX"
TRAILER_PREFIX = "BTRL-EQUIFAX"
MARKER_SUFFIX = "ADVITFINSCOREDA2"
