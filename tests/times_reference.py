"""A plain, row by row reading of times, to compare the operator with."""

import re
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from zoneinfo import ZoneInfo, available_timezones

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
NAMES = {z.lower(): z for z in available_timezones()}
SHORT = {"z": 0, "utc": 0, "gmt": 0, "est": -5, "edt": -4, "cet": 1, "cest": 2}
MONTH = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}


def micros(dt: datetime) -> int:
    return (dt - EPOCH) // timedelta(microseconds=1)


def read(raw, fmt, zone):
    """Microseconds since 1970 or None."""
    s = (raw or "").strip()
    if re.fullmatch(r"[+-]?\d+(\.\d*)?([eE][+-]?\d+)?", s) and not re.fullmatch(r"\d{8}", s):
        x = Decimal(s)
        for per_second in (1, 10**3, 10**6, 10**9):
            if 946684800 <= x / per_second < 2051222400:
                return int(x * 10**6 / per_second)
        return None
    fmt = fmt or ""
    m = re.match(r"(\d{4})-?/?(\d\d?)-?/?(\d\d?)(?!\d)", s)
    if m:
        y, mo, d = map(int, m.groups())
    elif m := re.match(r"(\d\d?)[-/.](\d\d?)[-/.](\d{4})", s):
        if fmt[:3] not in ("mdy", "dmy"):
            return None
        a, b, y = map(int, m.groups())
        mo, d = (a, b) if fmt[:3] == "mdy" else (b, a)
    elif m := re.match(r"(?:[A-Z][a-z]{2}, )?(\d\d?) ([A-Z][a-z]{2}) (\d{4})", s):
        d, mo, y = int(m[1]), MONTH.get(m[2].lower()), int(m[3])
        if not mo:
            return None
    else:
        return None
    rest = s[m.end():]
    h = mi = sec = us = 0
    bare = True
    if t := re.match(r"[T ](\d\d?):?(\d\d)(?::?(\d\d)(?:\.(\d+))?)?( [AP]M)?", rest):
        bare = False
        h, mi, sec = int(t[1]), int(t[2]), int(t[3] or 0)
        us = int((t[4] or "0")[:6].ljust(6, "0"))
        if t[5]:
            if not 1 <= h <= 12:
                return None
            h = h % 12 + (12 if "P" in t[5] else 0)
        rest = rest[t.end():]
    z = rest.strip().strip("[]")
    if z:
        if o := re.fullmatch(r"([+-])(\d\d):?(\d\d)?", z):
            tz = timezone((1 if o[1] == "+" else -1) * timedelta(hours=int(o[2]), minutes=int(o[3] or 0)))
        elif z.lower() in SHORT:
            tz = timezone(timedelta(hours=SHORT[z.lower()]))
        elif z.lower() in NAMES:
            tz = ZoneInfo(NAMES[z.lower()])
        else:
            return None
    elif zone == "us_market_close":
        tz = ZoneInfo("America/New_York")
        if bare:
            h = 16
    else:
        tz = timezone.utc if zone in (None, "unknown", "utc") else ZoneInfo(zone)
    try:
        return micros(datetime(y, mo, d, h, mi, sec, us, tzinfo=tz))  # fold 0: the first of two, the offset before a gap
    except ValueError:
        return None
