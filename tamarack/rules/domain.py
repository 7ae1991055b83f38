"""The default pack: baseball video. All of these are fixed values, which results depend on."""

from __future__ import annotations

# Wording of each type, in order of precedence, with the reason given.
PRIORITY = [
    ("short", [r"#shorts", r"\bshorts\b"], "short-form marker"),
    ("interview", [r"\binterview\b", r"press conference", r"media session", r"sits down with", r"\bpodcast\b", r"mic'd up", r"micd up"], "interview/talk format"),
    ("reaction", [r"\breaction\b", r"\breacts?\b", r"watching ", r"live stream", r"watch party"], "reaction format"),
    ("recap", [r"\brecap\b", r"\brewind\b"], "recap/rewind edit"),
    ("montage", [r"\bmontage\b", r"\bcinematic\b", r"\bcompilation\b", r"\bmix\b", r"\bmashup\b", r"\banalysis\b", r"\bbreakdown\b", r"film room", r"\bexplained\b"], "heavily edited feature"),
    ("pitching_highlights", [r"pitching highlights?", r"pitching debut"], "pitching-focused highlights"),
    ("general_highlights", [r"highlights?", r"\btop plays\b", r"\bmoments?\b", r"\bmust c\b", r"must see", r"\bsickest\b", r"\bnasty\b", r"\bfilthy\b", r"\binsane\b"], "general highlights/montage wording"),
    ("every_pitch", [r"every pitch"], "every-pitch structure"),
    ("full_outing", [r"full outing"], "full outing"),
    ("full_start", [r"full start"], "full start"),
    ("full_game", [r"complete game", r"full game", r"full match"], "full/complete game"),
]
# Long forms, in order, with the seconds from which highlight wording beside them does not count.
LONG_FORMS = [("every_pitch", 0), ("full_outing", 480), ("full_start", 480), ("full_game", 1800)]
# Wording that raises general highlights by a tier.
HINTS = [r"on the mound", r"strikeout", r"\bks\b", r"whiffs?", r"\bouting\b", r"\bstart\b", r"shutout", r"no-?hitter", r"perfect game"]
# Contexts outside the league, wording of league games, and relief wording that is no bullpen session.
OUTSIDE = [r"world baseball classic", r"\bwbc\b", r"\bnpb\b", r"nippon", r"japan series", r"\bkbo\b", r"korean series", r"\bcollege\b", r"\bncaa\b", r"high school", r"summer league", r"little league", r"\bamateur\b", r"\bdraft\b", r"bullpen( session)?", r"live bp\b", r"throwing session", r"\btraining\b", r"workout", r"practice", r"documentary", r"mic'd up", r"day in the life"]
INSIDE = [r"\bmlb\b", r"world series", r"postseason", r"opening day", r"regular season", r"all-star", r"all star", r"\bvs\.?\b", r"\btop \d+(st|nd|rd|th)\b", r"inning", r"shutout", r"complete game", r"full outing", r"every pitch", r"full start", r"full game"]
RELIEF = r"\b(out of|from) the (bullpen|['‘’]pen)\b"
CONTEXTS = ("non_mlb", "mlb", "unknown")
# Where a description's head ends, and months.
BOILERPLATE = ["About MLB", "ABOUT MLB", "Subscribe", "SUBSCRIBE", "Check out http", "CHECK OUT"]
MONTHS = "january february march april may june july august september october november december jan feb mar apr jun jul aug sep sept oct nov dec".split()
# Scores of types and channels, weights, and wording of edited material.
SEMANTIC = {"full_outing": 1.0, "every_pitch": 1.0, "full_start": 0.9, "full_game": 0.85, "pitching_highlights": 0.5, "general_highlights": 0.3, "recap": 0.15, "montage": 0.1, "unknown": 0.4, "short": 0.05, "interview": 0.05, "reaction": 0.1}
HOLD = {"full_outing": 0.9, "every_pitch": 0.9, "full_start": 0.85, "full_game": 0.8, "pitching_highlights": 0.45, "general_highlights": 0.3, "recap": 0.15, "montage": 0.1, "unknown": 0.4, "short": 0.05, "interview": 0.05, "reaction": 0.1}
WEIGHTS = {"semantic": 0.35, "duration": 0.20, "source": 0.20, "hold": 0.15, "risk": 0.35}
OFFICIAL = ["mlb", "espn", "fox sports", "tbs", "apple tv", "peacock", "dazn", "sny", "yes network", "nesn", "marquee", "bally", "sportsnet la", "snla", "dodgers", "yankees", "red sox", "mets", "cubs", "giants", "padres", "astros", "braves", "phillies", "pirates", "tigers", "guardians", "athletics"]
MEDIA = ["bleacher report", "barstool", "jomboymedia", "foul territory", "the athletic", "cbssports", "nbcsports", "sporting news", "mlb network"]
GENERIC = ["tv", "network", "sports", "baseball", "official"]
RISKY = ["montage", "mix", "#shorts", "shorts", "interview", "reaction", "compilation", "recap", "news", "podcast", "breakdown", "analysis", "explained", "film room", "mic'd up", "top 10", "funniest", "crying", "laughing", "emotional", "tribute", "insane", "filthy", "nastiest", "cinematic", "rewind", "highlights", "highlight", "best moments", "top plays", "condensed"]
QUERIES = ["{} full outing", "{} every pitch", "{} full start", "{} pitching full game", "{} complete game pitching", "{} vs full outing", "{} pitching highlights"]
