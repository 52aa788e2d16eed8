"""A field taken from the file name and put in front of every line."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import first_match


@dataclass(frozen=True)
class NameField:
    """``name`` heads the header line; data lines get the first match of ``pattern`` in their file name."""

    name: str
    pattern: str
    delimiter: str

    @classmethod
    def of(cls, name: str | None, pattern: str | None, delimiter: str | None) -> NameField | None:
        """White space and enclosing double quotes are cut off; the field is off if any part is then empty."""
        parts = [_bare(part) for part in (name, pattern, delimiter)]
        return cls(*parts) if all(parts) else None

    def head(self, header: str) -> str:
        return f"{self.name}{self.delimiter}{header}"

    def prefix(self, file_name: Column, line: Column) -> Column:
        return F.concat(first_match(file_name, self.pattern), F.lit(self.delimiter), line)


def _bare(part: str | None) -> str:
    return (part or "").strip().strip('"').strip()
