"""Text rendering of numbers inside SQL expressions."""


def grouped(value: str, decimals: int) -> str:
    """Thousands-grouped fixed-point text, ``n/a`` for null."""
    return f"coalesce(format_number({value}, {decimals}), 'n/a')"


def utc_now(fixed: str | None = None) -> str:
    """SQL for the time of the run as ISO text in UTC, which sorts as time does."""
    if fixed:
        return f"'{fixed}'"
    now = "to_utc_timestamp(current_timestamp(), current_timezone())"
    return f"concat(date_format({now}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
