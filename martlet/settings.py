"""Build options of the warehouse.

Two dialects are supported because the same warehouse is defined twice with
different semantics: ``"py"`` (elapsed days, unknown key 1, missing dates keyed
19000101) and ``"tsql"`` (calendar days, unknown key -1, missing delivery dates
left NULL).  ``"py"`` is the default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# They must equal the warehouse definition for right results.
UNKNOWN_DATE_KEY = 19000101
UNKNOWN_DATE = {
    "DateKey": 19000101, "FullDate": "1900-01-01", "DayNumber": 1, "DayName": "Monday",
    "WeekdayFlag": "Y", "WeekendFlag": "N", "WeekOfYear": 1, "MonthNumber": 1,
    "MonthName": "January", "QuarterNumber": 1, "QuarterName": "Q1", "YearNumber": 1900,
    "YearMonth": "1900-01", "IsHoliday": 0,
}
UNKNOWN_ID = "UNKNOWN"
UNKNOWN_STATE = "XX"
UNKNOWN_LABEL = "Unknown"
UNKNOWN_PAYMENT = "unknown"
UNDEFINED_PAYMENT = "not_defined"
STATES_BY_REGION = {
    "North": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Northeast": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Center-West": ("DF", "GO", "MS", "MT"),
    "Southeast": ("ES", "MG", "RJ", "SP"),
    "South": ("PR", "RS", "SC"),
}
MANUAL_CATEGORIES = {
    "pc_gamer": "pc_gamer",
    "portateis_cozinha_e_preparadores_de_alimentos": "portable_kitchen_food_preparers",
}


@dataclass(frozen=True)
class Settings:
    dialect: str = "py"
    calendar_start: str = "2016-01-01"
    calendar_end: str = "2018-12-31"
    light_below: float = 500.0
    heavy_from: float = 2000.0
    national_holidays_only: bool = False
    manual_categories: dict = field(default_factory=lambda: dict(MANUAL_CATEGORIES))

    def __post_init__(self):
        if self.dialect not in ("py", "tsql"):
            raise ValueError(f"dialect must be 'py' or 'tsql', not {self.dialect!r}")

    @property
    def is_py(self) -> bool:
        return self.dialect == "py"

    @property
    def unknown_key(self) -> int:
        return 1 if self.is_py else -1

    @property
    def first_key(self) -> int:
        """First key given to a real member: the py sentinel already holds 1."""
        return 2 if self.is_py else 1

    @property
    def unknown_city(self) -> str:
        return "unknown" if self.is_py else "Unknown"
