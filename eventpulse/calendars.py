"""Calendars of named event windows."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Match windows of the 2021 tournament as (name, first millisecond,
# end millisecond), relative to the base; the position is the bucket id.
TOURNAMENT_BASE_MS = 1623436200000
TOURNAMENT_WINDOWS = (
    ("TUR_ITA", 0, 12600000),
    ("WAL_SUI", 64800000, 75600000),
    ("DEN_FIN", 75600000, 86400000),
    ("BEL_RUS", 86400000, 97200000),
    ("ENG_CRO", 151200000, 162000000),
    ("AUS_MAC", 162000000, 172800000),
    ("NED_UKR", 172800000, 183600000),
    ("SCO_CZE", 237600000, 248400000),
    ("POL_SLOVAKIA", 248400000, 259200000),
    ("ESP_SWE", 259200000, 270000000),
    ("HUN_POR", 334800000, 345600000),
    ("FRA_GER", 345600000, 356400000),
    ("FIN_RUS", 410400000, 421200000),
    ("TUR_WAL", 421200000, 432000000),
    ("ITA_SUI", 432000000, 442800000),
    ("UKR_MAC", 496800000, 507600000),
    ("DEN_BEL", 507600000, 518400000),
    ("NED_AUS", 518400000, 529200000),
    ("SWE_SLOVAKIA", 583200000, 594000000),
    ("CRO_CZE", 594000000, 604800000),
    ("ENG_SCO", 604800000, 615600000),
    ("HUN_FRA", 669600000, 680400000),
    ("POR_GER", 680400000, 691200000),
    ("ESP_POL", 691200000, 702000000),
    ("SUI_TUR_AND_ITA_WAL", 766800000, 777600000),
    ("MAC_NED_AND_UKR_AUS", 853200000, 864000000),
    ("RUS_DEN_AND_FIN_BEL", 864000000, 874800000),
    ("CRO_SCO_AND_CZE_ENG", 950400000, 961200000),
    ("SWE_POL_AND_SLOV_ESP", 1026000000, 1036800000),
    ("POR_FRA_AND_GER_HUN", 1036800000, 1047600000),
    ("RO16_WAL_DEN", 1285200000, 1296000000),
    ("RO16_ITA_AUS", 1296000000, 1308000000),
    ("RO16_NED_CZE", 1371600000, 1382400000),
    ("RO16_BEL_POR", 1382400000, 1393200000),
    ("RO16_CRO_ESP", 1458000000, 1468800000),
    ("RO16_FRA_SUI", 1468800000, 1479600000),
    ("RO16_ENG_GER", 1544400000, 1555200000),
    ("RO16_SWE_UKR", 1555200000, 1566000000),
    ("RO8_SUI_ESP", 1803600000, 1814400000),
    ("RO8_BEL_ITA", 1814400000, 1825200000),
    ("RO8_CZE_DEN", 1890000000, 1900800000),
    ("RO8_UKR_ENG", 1900800000, 1911600000),
    ("SEMIS_ITA_ESP", 2160000000, 2172000000),
    ("SEMIS_ENG_DEN", 2246400000, 2258400000),
    ("FINAL_ENG_ITA", 2592000000, 2604000000),
)
BEFORE_NAME = "PRE_CUP"
OTHER_NAME = "POST_CUP"
UNKNOWN_NAME = "error"


@dataclass(frozen=True)
class Calendar:
    """Disjoint windows in time order, small enough to be written into a plan.

    Bucket ``i`` is the i-th window, ``before`` is everything earlier than the
    base and ``other`` is everything else: gaps, later times, unknown times.
    A calendar that is itself a table is a
    :class:`eventpulse.operators.windows.WindowTable`.
    """

    base_ms: int
    windows: tuple[tuple[str, int, int], ...]
    before_name: str = BEFORE_NAME
    other_name: str = OTHER_NAME

    # Keeps the generated search tree below the size up to which the JVM compiles it.
    MAX_WINDOWS = 80

    def __post_init__(self) -> None:
        if len(self.windows) > self.MAX_WINDOWS:
            raise ValueError(
                f"{len(self.windows)} windows do not fit into an expression; "
                "use a WindowTable"
            )
        end = 0
        for name, lo, hi in self.windows:
            if lo < end or hi <= lo:
                raise ValueError(f"window {name} is empty, out of order or overlaps")
            end = hi

    @property
    def before(self) -> int:
        return len(self.windows)

    @property
    def other(self) -> int:
        return len(self.windows) + 1

    @property
    def names(self) -> list[str]:
        """Names by bucket id."""
        return [w[0] for w in self.windows] + [self.before_name, self.other_name]

    def at(self, base_ms: int) -> Calendar:
        """The same windows counted from another base."""
        return replace(self, base_ms=base_ms)


TOURNAMENT = Calendar(TOURNAMENT_BASE_MS, TOURNAMENT_WINDOWS)
