"""How far a sheet's layout reaches."""

from dataclasses import dataclass

from setlog.functions import fixed


@dataclass(frozen=True)
class Layout:
    """Limits within which marks and values of a sheet are looked for; ends are exclusive.

    The defaults are those that the source format's results depend on. ``grid.grid_cuts`` lists
    the cells that a layout leaves out.
    """
    header_rows: int = fixed.HEADER_ROWS
    micro_first_col: int = fixed.MICRO_FIRST_COL
    micro_end_col: int = fixed.MICRO_END_COL
    label_first_col: int = fixed.LABEL_FIRST_COL
    label_end_col: int = fixed.LABEL_END_COL
    label_rows: int = fixed.LABEL_ROWS
    last_day_rows: int = fixed.LAST_DAY_ROWS
    sets: int = fixed.SETS_PER_EXERCISE
    date_offset: int = fixed.DATE_OFFSET
    time_offset: int = fixed.TIME_OFFSET
    number_offsets: int = fixed.NUMBER_OFFSETS

    @property
    def last_col(self) -> int:
        """The last column that a value can stand in."""
        reach = max(self.sets - 1, self.number_offsets, self.date_offset, self.time_offset)
        return self.micro_end_col - 1 + reach


LAYOUT = Layout()
