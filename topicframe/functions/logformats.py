"""Line formats for log payloads (clf, syslog, grok) as Java regular expressions.

Each format is one regex with numbered groups; a decoder picks groups by
field name and casts them. Everything runs as ``regexp_extract`` in the JVM.
"""

from __future__ import annotations

import re

# Common Log Format line, groups in order
# host, ident, authuser, timestamp, request, status, bytes, referrer, agent.
CLF_REGEX = (
    r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "((?:[^"\\]|\\.)*)" (\d{3}|-) (\d+|-)'
    r'(?: "((?:[^"\\]|\\.)*)" "((?:[^"\\]|\\.)*)")?\s*$'
)
CLF_GROUPS = {
    "host": 1, "remote_host": 1,
    "ident": 2, "remote_login": 2,
    "authuser": 3, "auth_user": 3, "user": 3,
    "timestamp": 4, "at": 4, "time": 4, "date": 4,
    "request": 5,
    "status": 6,
    "bytes": 7, "size": 7, "content_length": 7,
    "referrer": 8, "referer": 8,
    "agent": 9, "user_agent": 9,
}
CLF_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# RFC 3164 syslog line, groups in order
# priority, timestamp, host, app, pid, message.
SYSLOG_REGEX = r"^<(\d{1,3})>([A-Z][a-z]{2} [ \d]\d \d{2}:\d{2}:\d{2}) (\S+) ([^\[\]:\s]+)(?:\[(\d+)\])?: ?(.*)$"
# of the year and the line's time, with one blank between parts
SYSLOG_TIME_FORMAT = "yyyy MMM d HH:mm:ss"
SYSLOG_GROUPS = {
    "priority": 1, "pri": 1,
    "timestamp": 2, "time": 2,
    "host": 3, "hostname": 3, "logsource": 3,
    "app": 4, "program": 4, "tag": 4,
    "pid": 5,
    "message": 6, "msg": 6,
}
# derived from the priority group: facility = pri div 8, severity = pri mod 8
SYSLOG_DERIVED = ("facility", "severity")

# Grok pattern names and the regex each stands for.
GROK_PATTERNS = {
    "WORD": r"\b\w+\b",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "INT": r"[+-]?\d+",
    "POSINT": r"\b[1-9]\d*\b",
    "NONNEGINT": r"\b\d+\b",
    "NUMBER": r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)",
    "BASE16NUM": r"(?:0[xX])?[0-9A-Fa-f]+",
    "IPV4": r"(?:\d{1,3}\.){3}\d{1,3}",
    "HOSTNAME": r"\b[0-9A-Za-z][0-9A-Za-z-]{0,62}(?:\.[0-9A-Za-z][0-9A-Za-z-]{0,62})*\.?\b",
    "IPORHOST": r"(?:%{IPV4}|%{HOSTNAME})",
    "USER": r"[a-zA-Z0-9._-]+",
    "MONTH": r"\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\b",
    "MONTHDAY": r"(?:0[1-9]|[12]\d|3[01]|[1-9]| [1-9])",
    "YEAR": r"\d{4}",
    "TIME": r"\d{2}:\d{2}:\d{2}(?:\.\d+)?",
    "SYSLOGTIMESTAMP": r"%{MONTH} +%{MONTHDAY} %{TIME}",
    "HTTPDATE": r"%{MONTHDAY}/%{MONTH}/%{YEAR}:%{TIME} [+-]\d{4}",
    "PROG": r"[\w._/%-]+",
    "QS": r'"(?:[^"\\]|\\.)*"',
    "URIPATH": r"(?:/[\w.~:@!$&'()*+,;=%-]*)+",
    "LOGLEVEL": r"(?:TRACE|DEBUG|INFO|NOTICE|WARN|WARNING|ERROR|CRIT|CRITICAL|FATAL|SEVERE|ALERT|EMERG)",
}

_GROK_REF = re.compile(r"%\{(\w+)(?::(\w+))?(?::(\w+))?\}")


def expand_grok(pattern: str, extra: dict[str, str] | None = None) -> tuple[str, dict[str, int], dict[str, str]]:
    """Expand ``%{NAME:field[:type]}`` references to one Java regex.

    Returns the regex, ``{field: group number}`` and ``{field: type}``
    (``int``/``long``/``float``/``double`` when given). Unnamed references and
    all other parentheses, of the table's patterns too, become non-capturing
    so group numbers stay ours.
    """
    table = dict(GROK_PATTERNS)
    if extra:
        table.update(extra)
    groups: dict[str, int] = {}
    types: dict[str, str] = {}

    def inner(name: str, depth: int) -> str:
        if name not in table:
            raise ValueError(f"unknown grok pattern %{{{name}}}")
        if depth > 20:
            raise ValueError("grok patterns nest too deeply")
        return _GROK_REF.sub(lambda m: "(?:" + inner(m.group(1), depth + 1) + ")", _noncapturing(table[name]))

    out: list[str] = []
    pos = 0
    for m in _GROK_REF.finditer(pattern):
        literal = pattern[pos:m.start()]
        out.append(_noncapturing(literal))
        name, field, typ = m.group(1), m.group(2), m.group(3)
        body = inner(name, 0)
        if field:
            groups[field] = len(groups) + 1
            if typ:
                types[field] = typ
            out.append("(" + body + ")")
        else:
            out.append("(?:" + body + ")")
        pos = m.end()
    out.append(_noncapturing(pattern[pos:]))
    return "".join(out), groups, types


def _noncapturing(pattern: str) -> str:
    """Turn ``(`` groups into ``(?:``; escaped ones, those inside a character
    class and special groups stay."""
    out: list[str] = []
    in_class = False
    i = 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        if c == "[" and not in_class:
            in_class = True
        elif c == "]" and in_class and pattern[i - 1] != "[":
            in_class = False
        elif c == "(" and not in_class and pattern[i + 1 : i + 2] != "?":
            c = "(?:"
        out.append(c)
        i += 1
    return "".join(out)
