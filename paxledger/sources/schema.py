"""The relational model as data: columns, keys, foreign keys and their actions.

Key and count columns that grow with the data (flight, passenger and baggage numbers) are BIGINT
rather than INT, so that they do not overflow at scale.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

INT, LONG, TEXT, MOMENT = IntegerType(), LongType(), StringType(), TimestampNTZType()


@dataclass(frozen=True)
class Column:
    name: str
    type: object
    nullable: bool = False
    char: int | None = None  # fixed width: trailing blanks carry no meaning


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> StructType:
        # Spark reads files as nullable whatever is declared; NOT NULL is an audit, not a read option.
        return StructType([StructField(c.name, c.type, True) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    @property
    def char_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.char]


@dataclass(frozen=True)
class ForeignKey:
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    delete_cascades: bool
    update_cascades: bool

    @property
    def name(self) -> str:
        return f"{self.child}({','.join(self.columns)})->{self.parent}"


_ALL = (
    Table("balie", (Column("balienummer", INT),), ("balienummer",)),
    Table("gate", (Column("gatecode", TEXT, char=1),), ("gatecode",)),
    Table(
        "maatschappij",
        (Column("maatschappijcode", TEXT, char=2), Column("naam", TEXT)),
        ("maatschappijcode",),
        unique=("naam",),
    ),
    Table(
        "inchecken_bij_maatschappij",
        (Column("balienummer", INT), Column("maatschappijcode", TEXT, char=2)),
        ("balienummer", "maatschappijcode"),
    ),
    Table(
        "luchthaven",
        (Column("luchthavencode", TEXT, char=3), Column("naam", TEXT), Column("land", TEXT, nullable=True)),
        ("luchthavencode",),
        unique=("naam",),
    ),
    Table(
        "inchecken_voor_bestemming",
        (Column("balienummer", INT), Column("luchthavencode", TEXT, char=3)),
        ("balienummer", "luchthavencode"),
    ),
    Table("vliegtuig", (Column("vliegtuigtype", TEXT),), ("vliegtuigtype",)),
    Table(
        "vlucht",
        (
            Column("vluchtnummer", LONG),
            Column("gatecode", TEXT, char=1),
            Column("maatschappijcode", TEXT, char=2),
            Column("luchthavencode", TEXT, char=3),
            Column("vliegtuigtype", TEXT),
            Column("max_aantal_psgrs", INT),
            Column("max_totaalgewicht", DecimalType(5, 0)),
            Column("max_ppgewicht", DecimalType(5, 2)),
            # Declared nullable at first and tightened once the backfill has run.
            Column("vertrektijdstip", MOMENT),
            Column("aankomsttijdstip", MOMENT),
        ),
        ("vluchtnummer",),
    ),
    Table("inchecken_voor_vlucht", (Column("balienummer", INT), Column("vluchtnummer", LONG)), ("balienummer", "vluchtnummer")),
    Table(
        "passagier",
        (
            Column("passagiernummer", LONG),
            Column("naam", TEXT),
            Column("geslacht", TEXT, char=1),
            Column("geboortedatum", MOMENT),
        ),
        ("passagiernummer",),
    ),
    Table(
        "passagier_voor_vlucht",
        (
            Column("passagiernummer", LONG),
            Column("vluchtnummer", LONG),
            Column("balienummer", INT, nullable=True),
            Column("inchecktijdstip", MOMENT, nullable=True),
            Column("stoel", TEXT, nullable=True, char=3),
        ),
        ("passagiernummer", "vluchtnummer"),
    ),
    Table(
        "object",
        (Column("volgnummer", LONG), Column("passagiernummer", LONG), Column("vluchtnummer", LONG), Column("gewicht", INT)),
        ("volgnummer",),
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _ALL}


def _fk(child: str, columns: str, parent: str, delete: bool, update: bool) -> ForeignKey:
    names = tuple(columns.split(","))
    return ForeignKey(child, names, parent, names, delete, update)


FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    _fk("inchecken_bij_maatschappij", "maatschappijcode", "maatschappij", delete=True, update=True),
    _fk("inchecken_bij_maatschappij", "balienummer", "balie", delete=True, update=True),
    _fk("inchecken_voor_bestemming", "luchthavencode", "luchthaven", delete=True, update=True),
    _fk("inchecken_voor_bestemming", "balienummer", "balie", delete=True, update=True),
    _fk("vlucht", "gatecode", "gate", delete=False, update=True),
    _fk("vlucht", "maatschappijcode", "maatschappij", delete=False, update=True),
    _fk("vlucht", "luchthavencode", "luchthaven", delete=False, update=False),
    _fk("vlucht", "vliegtuigtype", "vliegtuig", delete=False, update=True),
    _fk("inchecken_voor_vlucht", "vluchtnummer", "vlucht", delete=True, update=True),
    _fk("inchecken_voor_vlucht", "balienummer", "balie", delete=True, update=True),
    _fk("passagier_voor_vlucht", "balienummer", "balie", delete=False, update=True),
    _fk("passagier_voor_vlucht", "vluchtnummer", "vlucht", delete=False, update=False),
    _fk("passagier_voor_vlucht", "passagiernummer", "passagier", delete=True, update=False),
    _fk("object", "passagiernummer,vluchtnummer", "passagier_voor_vlucht", delete=True, update=True),
)


def children_of(parent: str) -> list[ForeignKey]:
    return [fk for fk in FOREIGN_KEYS if fk.parent == parent]


#: Booking requests carry their arrival number, unique over one batch.
REQUEST_SCHEMA = StructType([StructField("seq", LONG), *TABLES["passagier_voor_vlucht"].schema.fields])
