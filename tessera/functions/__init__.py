from tessera.functions.tickets import calendar_day, decode, encode, parse, route_team, text_to_timestamp, timestamp_text

__all__ = ["calendar_day", "decode", "encode", "parse", "route_team", "text_to_timestamp", "timestamp_text"]
