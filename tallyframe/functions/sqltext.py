"""Literals and names inside SQL expression text."""


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"
