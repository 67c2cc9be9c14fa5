"""What a table should look like: its source, key, order and expected size."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableName:
    """A three-part warehouse name. Spark's session catalog has two levels, so the database
    and the schema join into one: ``db.schema.table`` becomes ``db_schema.table``."""

    database: str
    schema: str
    table: str

    @classmethod
    def parse(cls, name: str, database: str | None = None) -> "TableName":
        """``database`` may itself be ``db`` or ``db.schema``; the schema defaults to ``public``."""
        *left, table = name.split(".")
        left = database.split(".") if database else left
        return cls(left[0] if left else "default", left[1] if len(left) > 1 else "public", table)

    @property
    def catalog_database(self) -> str:
        return f"{self.database}_{self.schema}"

    @property
    def catalog_name(self) -> str:
        return f"{self.catalog_database}.{self.table}"


@dataclass(frozen=True)
class TableSpec:
    """The contract of one table.

    ``primary_key`` is a column name, or ``"A + B"`` with ``composite`` set. ``order_by`` decides
    which of several rows with one key is kept: the first in this order. ``multi_line`` says that quoted
    values span lines; such files cannot be split, so it is off unless a table needs it.
    """

    name: str
    source: str = ""
    primary_key: str | None = None
    composite: bool = False
    order_by: tuple[str, ...] = ()
    expected_rows: int | None = None
    renames: dict[str, str] = field(default_factory=dict)
    multi_line: bool = False

    @property
    def key_columns(self) -> list[str]:
        if not self.primary_key:
            return []
        if self.composite:
            return [part.strip() for part in self.primary_key.split("+")]
        return [self.primary_key]
