"""The execute date in stored tag SQL: replaced as text, or bound as a parameter."""

from __future__ import annotations

import re

from tagweave.codes import DATE_TOKEN, check_date

# Quoted text, quoted names and comments hold no parameter markers.
_QUOTED = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/""", re.DOTALL)
_MARKER = re.compile(rf"(?<![:\w]):{DATE_TOKEN}\b")


def has_marker(task_sql: str) -> bool:
    """Whether the SQL takes the date as the named parameter ``:executeDate``."""
    return bool(_MARKER.search(_QUOTED.sub("''", task_sql)))


def render_sql(task_sql: str, execute_date: str) -> str:
    """Replace every occurrence of the date token by the execute date.

    Plain text replacement: the token is also replaced inside quotes or
    identifiers, as stored SQL expects (``cast('executeDate' as date)``). In SQL with
    the marker ``:executeDate`` nothing is replaced: its date is bound.
    """
    if task_sql is None or not task_sql.strip():
        raise ValueError("task has no SQL")
    check_date(execute_date)
    return task_sql if has_marker(task_sql) else task_sql.replace(DATE_TOKEN, execute_date)


def sql_arguments(task_sql: str, execute_date: str) -> dict[str, str]:
    """Arguments of :func:`render_sql`'s text: the date as text, where the SQL has its marker."""
    return {DATE_TOKEN: check_date(execute_date)} if has_marker(task_sql) else {}
