"""Emoji features. Emoji are matched per code point, by a character class."""

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentiment weight per emoji.
EMOJI_WEIGHTS = {
    "😊": 0.8, "😃": 0.9, "😄": 0.9, "😁": 0.8, "🙂": 0.6, "😀": 0.9,
    "😍": 1.0, "🥰": 1.0, "😘": 0.9, "💕": 0.9, "❤️": 0.9, "💖": 0.9,
    "👍": 0.7, "👏": 0.7, "🙌": 0.8, "✨": 0.6, "🌟": 0.7, "⭐": 0.6,
    "😢": -0.8, "😭": -0.9, "😞": -0.7, "😔": -0.7, "☹️": -0.6, "🙁": -0.6,
    "😠": -0.9, "😡": -1.0, "🤬": -1.0, "😤": -0.8, "💔": -0.9,
    "😱": -0.8, "😨": -0.7, "😰": -0.7, "😓": -0.6, "😖": -0.7,
    "🌞": 0.7, "☀️": 0.6, "🌈": 0.8, "🌸": 0.6, "🌺": 0.6,
    "🌊": 0.0, "💧": 0.0, "🌧️": -0.3, "⛈️": -0.5, "🌪️": -0.7,
    "🔥": -0.4, "💨": -0.2, "❄️": 0.0, "🌡️": 0.0,
}

# Unicode short names of the same emoji.
EMOJI_NAMES = {
    "😊": "smiling_face_with_smiling_eyes", "😃": "grinning_face_with_big_eyes",
    "😄": "grinning_face_with_smiling_eyes", "😁": "beaming_face_with_smiling_eyes",
    "🙂": "slightly_smiling_face", "😀": "grinning_face", "😍": "smiling_face_with_heart-eyes",
    "🥰": "smiling_face_with_hearts", "😘": "face_blowing_a_kiss", "💕": "two_hearts",
    "❤": "red_heart", "💖": "sparkling_heart", "👍": "thumbs_up", "👏": "clapping_hands",
    "🙌": "raising_hands", "✨": "sparkles", "🌟": "glowing_star", "⭐": "star",
    "😢": "crying_face", "😭": "loudly_crying_face", "😞": "disappointed_face",
    "😔": "pensive_face", "☹": "frowning_face", "🙁": "slightly_frowning_face",
    "😠": "angry_face", "😡": "enraged_face", "🤬": "face_with_symbols_on_mouth",
    "😤": "face_with_steam_from_nose", "💔": "broken_heart", "😱": "face_screaming_in_fear",
    "😨": "fearful_face", "😰": "anxious_face_with_sweat", "😓": "downcast_face_with_sweat",
    "😖": "confounded_face", "🌞": "sun_with_face", "☀": "sun", "🌈": "rainbow",
    "🌸": "cherry_blossom", "🌺": "hibiscus", "🌊": "water_wave", "💧": "droplet",
    "🌧": "cloud_with_rain", "⛈": "cloud_with_lightning_and_rain", "🌪": "tornado",
    "🔥": "fire", "💨": "dashing_away", "❄": "snowflake", "🌡": "thermometer",
}

# Code points with the Unicode Emoji property that NFKC leaves as they are (digits and
# regional indicators are emoji only in sequences and are left out).
EMOJI_RANGES = (
    r"\x{A9}\x{AE}\x{2194}-\x{2199}\x{21A9}\x{21AA}\x{231A}\x{231B}\x{2328}\x{23CF}"
    r"\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{25AA}\x{25AB}\x{25B6}\x{25C0}\x{25FB}-\x{25FE}"
    r"\x{2600}-\x{2604}\x{260E}\x{2611}\x{2614}\x{2615}\x{2618}\x{261D}\x{2620}\x{2622}\x{2623}"
    r"\x{2626}\x{262A}\x{262E}\x{262F}\x{2638}-\x{263A}\x{2640}\x{2642}\x{2648}-\x{2653}"
    r"\x{265F}\x{2660}\x{2663}\x{2665}\x{2666}\x{2668}\x{267B}\x{267E}\x{267F}"
    r"\x{2692}-\x{2697}\x{2699}\x{269B}\x{269C}\x{26A0}\x{26A1}\x{26A7}\x{26AA}\x{26AB}"
    r"\x{26B0}\x{26B1}\x{26BD}\x{26BE}\x{26C4}\x{26C5}\x{26C8}\x{26CE}\x{26CF}\x{26D1}"
    r"\x{26D3}\x{26D4}\x{26E9}\x{26EA}\x{26F0}-\x{26F5}\x{26F7}-\x{26FA}\x{26FD}\x{2702}"
    r"\x{2705}\x{2708}-\x{270D}\x{270F}\x{2712}\x{2714}\x{2716}\x{271D}\x{2721}\x{2728}"
    r"\x{2733}\x{2734}\x{2744}\x{2747}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2763}\x{2764}"
    r"\x{2795}-\x{2797}\x{27A1}\x{27B0}\x{27BF}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}"
    r"\x{2B50}\x{2B55}\x{3030}\x{303D}\x{1F004}\x{1F0CF}\x{1F170}\x{1F171}\x{1F17E}\x{1F17F}"
    r"\x{1F18E}\x{1F191}-\x{1F19A}\x{1F300}-\x{1F321}\x{1F324}-\x{1F393}\x{1F396}\x{1F397}"
    r"\x{1F399}-\x{1F39B}\x{1F39E}-\x{1F3F0}\x{1F3F3}-\x{1F3F5}\x{1F3F7}-\x{1F4FD}"
    r"\x{1F4FF}-\x{1F53D}\x{1F549}-\x{1F54E}\x{1F550}-\x{1F567}\x{1F56F}\x{1F570}"
    r"\x{1F573}-\x{1F57A}\x{1F587}\x{1F58A}-\x{1F58D}\x{1F590}\x{1F595}\x{1F596}\x{1F5A4}\x{1F5A5}"
    r"\x{1F5A8}\x{1F5B1}\x{1F5B2}\x{1F5BC}\x{1F5C2}-\x{1F5C4}\x{1F5D1}-\x{1F5D3}"
    r"\x{1F5DC}-\x{1F5DE}\x{1F5E1}\x{1F5E3}\x{1F5E8}\x{1F5EF}\x{1F5F3}\x{1F5FA}-\x{1F64F}"
    r"\x{1F680}-\x{1F6C5}\x{1F6CB}-\x{1F6D2}\x{1F6D5}-\x{1F6D9}\x{1F6DC}-\x{1F6E5}\x{1F6E9}"
    r"\x{1F6EB}\x{1F6EC}\x{1F6F0}\x{1F6F3}-\x{1F6FC}\x{1F7E0}-\x{1F7EB}\x{1F7F0}"
    r"\x{1F90C}-\x{1F93A}\x{1F93C}-\x{1F945}\x{1F947}-\x{1F9FF}\x{1FA70}-\x{1FA7C}"
    r"\x{1FA80}-\x{1FAC6}\x{1FAC8}\x{1FACC}-\x{1FADD}\x{1FADF}-\x{1FAEB}"
    r"\x{1FAEF}-\x{1FAFA}"
)
VARIATION_SELECTOR = "️"


def emoji_points(ranges: str = EMOJI_RANGES) -> list[str]:
    """Every character of the class."""
    spans = re.findall(r"\\x\{(\w+)\}(?:-\\x\{(\w+)\})?", ranges)
    return [chr(c) for low, high in spans for c in range(int(low, 16), int(high or low, 16) + 1)]


def all_names(first: dict[str, str] = EMOJI_NAMES) -> dict[str, str]:
    """A name for every emoji: the given one, else the character's Unicode name in lower case."""
    known = {e: unicodedata.name(e, "") for e in emoji_points()}
    return {e: n.lower().replace(" ", "_") for e, n in known.items() if n} | first


def base_weights(strict_codepoint: bool = False) -> dict[str, float]:
    """Weights by single code point.

    Eight lexicon entries carry a variation selector, which a code-point match never sees. By
    default they are keyed on their base character so that they score; ``strict_codepoint``
    leaves them at 0.
    """
    if strict_codepoint:
        return {e: w for e, w in EMOJI_WEIGHTS.items() if len(e) == 1}
    return {e.replace(VARIATION_SELECTOR, ""): w for e, w in EMOJI_WEIGHTS.items()}


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


# Everything below the arrows except the two signs: dropped first, by a class that is fast to test.
NO_EMOJI_RUN = r"[\x{0}-\x{A8}\x{AA}-\x{AD}\x{AF}-\x{2193}]+"


def emoji_list(text: Column) -> Column:
    """The emoji of a text, in order, one entry per code point."""
    symbols = F.regexp_replace(text, NO_EMOJI_RUN, "")
    only = F.regexp_replace(symbols, f"[^{EMOJI_RANGES}]+", "")
    return F.filter(F.split(only, ""), lambda e: e != "")


def emoji_score(emojis: Column, weights: dict[str, float] | None = None) -> Column:
    table = _literal_map(weights or base_weights())
    total = F.aggregate(
        emojis,
        F.lit(0.0),
        lambda acc, e: acc + F.coalesce(F.try_element_at(table, e), F.lit(0.0)),
    )
    return F.round(total, 3)


def emoji_tokens(text: Column, emojis: Column, names: dict[str, str] | None = None) -> Column:
    """Replace each named emoji (and a variation selector after it) by `` :name: ``; by default
    every emoji has a name.

    ``emojis`` lists the emoji of the text, so texts without any cost nothing.
    """
    # One literal: a map built entry by entry would take the planner seconds.
    pairs = "\n".join(f"{e}\t :{n}: " for e, n in (names or all_names()).items())
    table = F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("\t"))
    named = F.filter(F.array_distinct(emojis), lambda e: F.map_contains_key(table, e))

    def spell(acc: Column, e: Column) -> Column:
        token = F.try_element_at(table, e)
        return F.replace(F.replace(acc, F.concat(e, F.lit(VARIATION_SELECTOR)), token), e, token)

    return F.aggregate(named, text, spell)
