from .dates import date_parts, date_text, parse_mdy, to_mdy

__all__ = ["date_parts", "date_text", "parse_mdy", "to_mdy"]
