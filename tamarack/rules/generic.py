"""A pack for invented prose: word fragments that its documents do have. Patterns avoid \\b and \\d, which engines read differently."""

from __future__ import annotations

from .domain import LONG_FORMS, PRIORITY as _ORDER

__all__ = ["CONTEXTS", "HINTS", "INSIDE", "LONG_FORMS", "OUTSIDE", "PRIORITY", "RELIEF"]

WORDING = {
    "short": [r"ing sh"], "interview": [r"licen[sc]e|copyright"], "reaction": [r"@[a-z]+\.", r"https?://"], "recap": [r"[|]"], "montage": [r"[*][*][*]", r"%%%"], "pitching_highlights": [r"ndle ", r"keit der"],
    "general_highlights": [r"thion", r"ction", r"schen"], "every_pitch": [r"ciones"], "full_outing": [r"the anea"], "full_start": [r"eaux "], "full_game": [r"lich ", r"with the"],
}
#: Order, names and reasons are the default pack's; its seconds of long forms hold here too.
PRIORITY = [(name, WORDING[name], reason) for name, _, reason in _ORDER]
HINTS = [r"tion ", r"heit"]
OUTSIDE = [r"nicht", r"para "]
INSIDE = [r"the ", r"und "]
RELIEF = r"(aber|das) nicht"
CONTEXTS = ("outside", "inside", "unknown")
