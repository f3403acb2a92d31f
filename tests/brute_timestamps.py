"""Brute-force reading of one value at a time, for comparison."""

from __future__ import annotations

import datetime as dt
import re
import zoneinfo

MON = {m: i for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
ABBR = {"Z": 0, "UTC": 0, "GMT": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
EPOCH = dt.datetime(1970, 1, 1)


def day(value, order):
    v = (value or "").strip()
    v = re.sub(r"[T ]00:00(:00(\.0+)?)?$", "", v)
    found = set()

    def put(y, m, d):
        try:
            found.add(dt.date(int(y), int(m), int(d)).isoformat())
        except ValueError:
            pass

    if m := re.fullmatch(r"(\d{4})([-/.]?)(\d{1,2})\2(\d{1,2})", v):
        if m[2] or len(v) == 8:
            put(m[1], m[3], m[4])
    elif m := re.fullmatch(r"(\d{1,2}) ([A-Za-z]+) (\d{4})", v):
        put(m[3], MON.get(m[2][:3].lower(), 0), m[1])
    elif m := re.fullmatch(r"([A-Za-z]+) (\d{1,2}), (\d{4})", v):
        put(m[3], MON.get(m[1][:3].lower(), 0), m[2])
    elif m := re.fullmatch(r"(\d{1,2})([-/.])(\d{1,2})\2(\d{4})", v):
        if order != "mdy":
            put(m[4], m[3], m[1])
        if order != "dmy":
            put(m[4], m[1], m[3])
    return found.pop() if len(found) == 1 else None


def instant(value, zone):
    v = (value or "").strip()
    if re.fullmatch(r"\d{10}", v):
        return _text(EPOCH + dt.timedelta(seconds=int(v)))
    if re.fullmatch(r"\d{13}", v):
        return _text(EPOCH + dt.timedelta(milliseconds=int(v)))
    m = re.search(r"(\d{1,2}):?(\d{2})(?::?(\d{2})(?:\.(\d+))?)? ?([AaPp]\.?[Mm]\.?)? ?(Z|UTC|GMT|[ECMP][SD]T|[+-]\d\d:?\d\d)?$", v)
    if not m:
        return None
    head = v[: m.start()].rstrip(" T")
    head = re.sub(r"^[A-Za-z]{3}, ", "", head).rstrip(",")
    d = day(head, None)
    if d is None or re.fullmatch(r"\d{4}", head):
        return None
    h, mi, s = int(m[1]), int(m[2]), int(m[3] or 0)
    if m[5]:
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if m[5][0] in "pP" else 0)
    try:
        local = dt.datetime.combine(dt.date.fromisoformat(d), dt.time(h, mi, s, int(((m[4] or "") + "000000")[:6])))
    except ValueError:
        return None
    z = m[6]
    if z:
        if z in ABBR:
            return _text(local - dt.timedelta(hours=ABBR[z]))
        shift = dt.timedelta(hours=int(z[1:3]), minutes=int(z[-2:]))
        return _text(local - shift if z[0] == "+" else local + shift)
    if not zone:
        return None
    tz = zoneinfo.ZoneInfo(zone)
    seen = set()
    for fold in (0, 1):
        utc = local.replace(tzinfo=tz, fold=fold).astimezone(dt.UTC)
        if utc.astimezone(tz).replace(tzinfo=None) == local:
            seen.add(utc.replace(tzinfo=None))
    return _text(seen.pop()) if len(seen) == 1 else None


def _text(x):
    return x.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
