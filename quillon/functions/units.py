"""Unit strings: segmentation by dynamic programming over a trie of prefixes, roots, numbers and exponents.

:func:`readings` returns every decomposition of a string with its cost; :func:`resolve` scores them with the
prior of the field (the dimensions its units have) and gives the factor to the field's default unit.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Decimal prefixes with their scale. A prefix in MULTIPLIERS may also stand alone as a count.
PREFIXES = {
    "f": 1e-15, "femto": 1e-15, "p": 1e-12, "pico": 1e-12, "n": 1e-9, "nano": 1e-9, "u": 1e-6, "μ": 1e-6, "mc": 1e-6,
    "micro": 1e-6, "m": 1e-3, "milli": 1e-3, "毫": 1e-3, "微": 1e-6, "c": 1e-2, "d": 1e-1, "deci": 1e-1, "k": 1e3, "kilo": 1e3,
    "M": 1e6, "mega": 1e6, "G": 1e9, "giga": 1e9, "T": 1e12, "tera": 1e12,
}
MULTIPLIERS = {
    "K": 1e3, "k": 1e3, "thou": 1e3, "thousand": 1e3, "M": 1e6, "mill": 1e6, "million": 1e6, "G": 1e9, "giga": 1e9,
    "T": 1e12, "tera": 1e12, "万": 1e4, "亿": 1e8,
}
# Unit roots as (dimension exponents, scale). Volumes are lengths cubed.
ROOTS = {
    "g": ({"g": 1}, 1.0), "gm": ({"g": 1}, 1.0), "gram": ({"g": 1}, 1.0), "grams": ({"g": 1}, 1.0), "克": ({"g": 1}, 1.0),
    "mol": ({"mol": 1}, 1.0), "mole": ({"mol": 1}, 1.0), "M": ({"mol": 1, "m": -3}, 1e3), "摩尔": ({"mol": 1}, 1.0),
    "L": ({"m": 3}, 1e-3), "liter": ({"m": 3}, 1e-3), "litre": ({"m": 3}, 1e-3), "升": ({"m": 3}, 1e-3), "cc": ({"m": 3}, 1e-6),
    "cumm": ({"m": 3}, 1e-9), "m": ({"m": 1}, 1.0), "meter": ({"m": 1}, 1.0), "metre": ({"m": 1}, 1.0), "米": ({"m": 1}, 1.0),
    "U": ({"U": 1}, 1.0), "IU": ({"U": 1}, 1.0), "I.U.": ({"U": 1}, 1.0), "unit": ({"U": 1}, 1.0), "units": ({"U": 1}, 1.0), "单位": ({"U": 1}, 1.0),
    "kat": ({"mol": 1, "s": -1}, 1.0), "katal": ({"mol": 1, "s": -1}, 1.0), "Eq": ({"Eq": 1}, 1.0),
    "s": ({"s": 1}, 1.0), "sec": ({"s": 1}, 1.0), "sec.": ({"s": 1}, 1.0), "secs": ({"s": 1}, 1.0), "second": ({"s": 1}, 1.0), "seconds": ({"s": 1}, 1.0),
    "Sek": ({"s": 1}, 1.0), "Sek.": ({"s": 1}, 1.0), "Sekunden": ({"s": 1}, 1.0), "秒": ({"s": 1}, 1.0),
    "min": ({"s": 1}, 60.0), "minute": ({"s": 1}, 60.0), "分钟": ({"s": 1}, 60.0),
    "h": ({"s": 1}, 3600.0), "hr": ({"s": 1}, 3600.0), "hour": ({"s": 1}, 3600.0), "Std": ({"s": 1}, 3600.0), "小时": ({"s": 1}, 3600.0),
    "d": ({"s": 1}, 86400.0), "day": ({"s": 1}, 86400.0),
    "%": ({}, 1e-2), "percent": ({}, 1e-2), "per cent": ({}, 1e-2), "pct": ({}, 1e-2), "Prozent": ({}, 1e-2),
    "‰": ({}, 1e-3), "o/oo": ({}, 1e-3), "0/00": ({}, 1e-3), "per mille": ({}, 1e-3), "permille": ({}, 1e-3), "Promille": ({}, 1e-3),
    "ratio": ({}, 1.0), "fraction": ({}, 1.0), "Anteil": ({}, 1.0), "1": ({}, 1.0), "比值": ({}, 1.0),
    "cell": ({}, 1.0), "cells": ({}, 1.0), "个": ({}, 1.0), "count": ({}, 1.0),
}
_SUPER = {"⁰": "0", "¹": "1", "²": "2", "³": "3", "⁴": "4", "⁵": "5", "⁶": "6", "⁷": "7", "⁸": "8", "⁹": "9", "⁻": "-", "⁺": ""}
_NUMBER = re.compile(r"10\s*(?:\^|[eE*]|\*\*)\s*([+-]?\d{1,2})|(\d+(?:\.\d+)?)")
_EXP = re.compile(r"\^?\s*([+-]?\d)(?!\d)")
_DIVIDE, _TIMES = ("/", "per", "每"), ("·", "*", "x", "×", ".", " ")


def plain(text: str) -> str:
    """One spelling: superscripts become ``^n``, then compatibility forms, signs and spaces are unified."""
    text = re.sub("[" + "".join(_SUPER) + "]+", lambda m: "^" + "".join(_SUPER[c] for c in m[0]), text)
    text = unicodedata.normalize("NFKC", text).replace("µ", "μ").replace("∙", "·").replace("⋅", "·").replace("−", "-").replace("∕", "/")
    return re.sub(r"\s+", " ", text).strip()


def _trie() -> dict:
    root: dict = {}
    for kind, words in (("pre", PREFIXES), ("mul", MULTIPLIERS), ("root", ROOTS), ("div", dict.fromkeys(_DIVIDE)), ("times", dict.fromkeys(_TIMES)), ("cubic", {"cubic": None, "cu": None})):
        for word, payload in words.items():
            node = root
            for ch in word.lower():
                node = node.setdefault(ch, {})
            node.setdefault("", []).append((kind, word, payload))
    return root


_TRIE = _trie()


def _lexemes(s: str, at: int):
    """Every lexeme of the trie that starts at ``at``: (end, kind, payload, cost)."""
    node, i = _TRIE, at
    while i < len(s) and (node := node.get(s[i].lower())) is not None:
        i += 1
        for kind, word, payload in node.get("", ()):
            yield i, kind, payload, 1.0 + 0.75 * (s[at:i] != word)


def _times(dims: tuple, base: dict, power: int) -> tuple:
    """Dimension exponents after multiplying by ``base`` to ``power``."""
    d = dict(dims)
    for k, v in base.items():
        d[k] = d.get(k, 0) + v * power
    return tuple(sorted((k, v) for k, v in d.items() if v))


@lru_cache(maxsize=20_000)
def readings(text: str) -> tuple[tuple[float, tuple, float], ...]:
    """Decompositions as ``(cost, dimensions, scale)``, cheapest first; none if the string is no unit."""
    s = plain(text)
    if not s:
        return ()
    # A state: kind of the last lexeme, sign of the exponents that follow, dimensions and scale so far, a prefix
    # that waits for its root, whether "cubic" waits, and the last root (dimensions, scale) for its exponent.
    table: list[dict] = [{} for _ in range(len(s) + 1)]
    table[0]["start", 1, (), 1.0, None, False, None] = 0.0

    def put(i: int, cost: float, *state) -> None:
        if cost < table[i].get(state, 1e9):
            table[i][state] = cost

    for i in range(len(s)):
        for (last, sign, dims, scale, pre, cubic, root), cost in list(table[i].items()):
            opens = last in ("start", "op", "num")
            if s[i] == " " and pre is None:
                put(i + 1, cost + 0.1, last, sign, dims, scale, pre, cubic, root)
            if opens and pre is None and (m := _NUMBER.match(s, i)):
                value = 10.0 ** int(m[1]) if m[1] else float(m[2])
                if value > 0:
                    put(m.end(), cost + 1, "num", sign, dims, scale * value**sign, None, cubic, None)
            if last == "root" and pre is None and (m := _EXP.match(s, i)) and int(m[1]):
                base, one = root
                power = sign * (int(m[1]) - 1)
                put(m.end(), cost + 1, "exp", sign, _times(dims, dict(base), power), scale * one**power, None, False, None)
            for end, kind, payload, c in _lexemes(s, i):
                if kind in ("div", "times"):
                    leads = last == "start" and (kind == "div" or s[i] in "x×X")
                    if pre is None and (last in ("root", "exp", "num", "mul") or leads):
                        after = -1 if kind == "div" else 1 if s[i] in "·." else sign
                        put(end, cost + c - 0.5, "op", after, dims, scale, None, False, None)
                elif kind == "cubic":
                    if opens and pre is None:
                        put(end, cost + c, "op", sign, dims, scale, None, True, None)
                elif kind == "mul":
                    if opens and pre is None:
                        put(end, cost + c + 0.5, "mul", sign, dims, scale * payload**sign, None, False, None)
                elif kind == "pre":
                    if opens and pre is None:
                        put(end, cost + c, last, sign, dims, scale, payload, cubic, None)
                else:
                    base, own = payload
                    mass = ("g", 1) in dims and all(v > 0 for _, v in dims)
                    if pre is None and last in ("root", "exp") and not base and own == 1e-2 and mass:
                        # a mass "per cent" is the mass in 100 mL
                        put(end, cost + c, "exp", sign, _times(dims, {"m": -3}, 1), scale / 1e-4, None, False, None)
                    elif (opens or last == "mul") and (pre is None or base):
                        one, cube = (pre or 1.0) * own, 3 if cubic and base == {"m": 1} else 1
                        put(end, cost + c, "root", sign, _times(dims, base, sign * cube), scale * one ** (sign * cube), None, False, (tuple(base.items()), one))
    best: dict = {}
    for (last, _, dims, scale, pre, _, _), cost in table[len(s)].items():
        if pre is None and last in ("root", "exp", "num", "mul"):
            key = (dims, float(f"{scale:.9g}"))
            best[key] = min(cost, best.get(key, 1e9))
    return tuple(sorted((c, d, s) for (d, s), c in best.items()))


@lru_cache(maxsize=20_000)
def resolve(text: str | None, field: tuple[tuple[str, float], ...]) -> tuple[str, float] | None:
    """The unit of ``field`` that ``text`` means, and the factor to the field's default unit.

    ``field`` holds ``(unit, factor)`` pairs, the default unit with factor 1. The prior of a decomposition is its
    dimension: one that none of the field's units has is refused, one that meets a unit of the field exactly is
    preferred to one that differs by a power of ten. None: the text states no unit of this field.
    """
    if not text:
        return None
    best = None
    for cost, dims, scale in readings(text):
        for unit, factor in field:
            own = readings(unit)
            if not own or own[0][1] != dims:
                continue
            ratio = scale / own[0][2]
            exact = abs(ratio - 1) < 1e-6
            rank = (cost + (0 if exact else 3), not exact, abs(ratio - 1))
            if best is None or rank < best[0]:
                best = (rank, unit, factor * (1.0 if exact else float(f"{ratio:.9g}")))
    return best and (best[1], best[2])
