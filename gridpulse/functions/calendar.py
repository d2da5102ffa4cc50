"""Calendar features of a zone-less UTC timestamp, as SQL text.

Text, because a feature list is long and one parsed string costs far less on the driver than a tree
of Column calls.
"""

from __future__ import annotations


def local_hour(time_col: str, zone: str) -> str:
    """Hour of day in ``zone``; ``EST`` is a fixed five hours behind UTC, without daylight saving."""
    return f"hour(convert_timezone('UTC', '{zone}', `{time_col}`))"


def hour_encoding(hour: str) -> dict[str, str]:
    """The hour as a point on the unit circle, rounded to four places."""
    angle = f"({hour} * 2 * pi() / 24)"
    return {"sine_hour": f"round(sin({angle}), 4)", "cosine_hour": f"round(cos({angle}), 4)"}


def daypart_flags(hour: str) -> dict[str, str]:
    """Morning [5, 12), afternoon [12, 17), evening [17, 21), night otherwise.

    An unknown hour belongs to the night.
    """

    def within(lo: int, hi: int) -> str:
        return f"coalesce({hour} >= {lo} AND {hour} < {hi}, false)"

    return {
        "is_morning": within(5, 12),
        "is_afternoon": within(12, 17),
        "is_evening": within(17, 21),
        "is_night": f"NOT {within(5, 21)}",
    }


def calendar_features(time_col: str, zone: str) -> dict[str, str]:
    hour = local_hour(time_col, zone)
    return {**hour_encoding(hour), **daypart_flags(hour)}


def aliased(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]
