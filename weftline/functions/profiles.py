"""Lexicons of a script: delimiters and the words that decide where sentences end."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: Tibetan punctuation and word classes ---------------------------------
SHAD, DOUBLE_SHAD, TER_TSHEG, TSHEG = "།", "༎", "༔", "་"
TERMINATORS = "གོ ངོ ཏོ ཐོ དོ ནོ བོ མོ འོ རོ ལོ སོ"
OPTATIVES = "གྱུར་ཅིག ཅིག ཞིག རོགས རོགས་གནང ཤིག ཤོག"
SENTENCE_INITIAL = (
    "གཞན་དུ་ན གཞན་ཡང གལ་ཏེ གལ་སྲིད དེ་ནས དེ་ཕྱིར དེ་བཞིན་དུ དེ་བས་ན དེ་མ་གཏོགས དེ་མ་ཐག དེ་མ་ཡིན དེ་མིན དེ་ཡང "
    "དེ་ལྟ་བས་ན དེའི་ཕྱིར དེའི་རྗེས དེར་ཡང དེས་ན མདོར་ན མདོར་བསྡུས་ན འོ་ན འོན་ཀྱང འོན་ཏེ ཡང་ན ཡོང་ནི སྤྱིར་བཏང སྤྱིར་ཡང སྤྱིར་ལ སླར་ཡང"
)
GERUNDS = "ཀྱིན ནས བཞིན བཞིན་དུ བཞིན་པ བཞིན་པར"
PARTICLES = "ཀྱང ཀྱི ཀྱིས གི གིས གྱི ཅིང ཏུ ཏེ དང དུ ན ནས པས ཕྱིར བས ཞིང འང འམ འི ཡང ཡི ཡིས རུ ལ ལས ལྟར སུ སྟེ"
ADVERBIALIZERS = "པར བར"
TOPICS = "ནི"
CORRELATIVE_FIRST = "ཅི་བཞིན ཅི་ཙམ ཅི་ཞིག ཅི་འདྲ ཅི་ལྟར ཅི་སྟེ ཇི་བཞིན ཇི་ཙམ ཇི་ལྟར ཇི་སྐད ཇི་སྙེད ཇི་སྲིད"
CORRELATIVE_SECOND = "དེ་བཞིན དེ་ཙམ དེ་འདྲ དེ་ལྟར དེ་སྐད དེ་སྙེད དེ་སྲིད"
CONTINUATORS = "ཀྱང ཅིང ཏེ དང་ དེ ནས ཞིང འང ཡང ཤིང སྟེ"
SECTION_MARKERS = "༠ ༡ ༢ ༣ ༤ ༥ ༦ ༧ ༨ ༩ དང་པོ གཉིས་པ གསུམ་པ བཞི་པ ལྔ་པ"

#: Particles in transliteration that carry no content (fixed values).
EWTS_PARTICLES = (
    "'am 'ang 'byung 'di 'dir 'dod 'dris 'dug 'ga' 'gro 'gyur 'i 'is 'khris 'o 'og 'ong 'os 'u am ang ba bam bar bas "
    "bcas bdag bo brgal brjod bshad bstan bu bya byang byung bzhin cad cag can ce cha che ched cher chog ci cig cing cog "
    "da dag dam dang dbang de dgos di dka' dkyil do don dper drung du dus g.yas g.yon ga gal gam gang ge gi gin gis gnang "
    "go gong grags gsung gsungs gyi gyin gyis gyur gzhan gzhung i is ji ka kha khar kho khongs khrod khyed khyod klong ko "
    "kun kyang kyi kyin kyis la lam lan las ldan lho lo lta ltar lung mam mang mdo mdun med min mo mod mthu myong na nam "
    "nang nas nga ngam ngang nge'u nged ngo ngor ngos ni no nub nus nyid o pa par pho phod phrag phyi phyin phyir po r ram "
    "re red rgya rgyab rgyud rigs ring rjes rkyen rnams ro rting rtsa ru rung sam sgang sgo shar she shig shing shog skabs "
    "skad skol skor skyin sla slad slar smra smra'o smras snga sngon snyam so sogs song spyir ste steng su ta tam te thams "
    "thog thub to tsam tshar tshe tsho tshul tu u yang yi yin yis yod yong yongs zer zhabs zhal zhe zhig zhing zin"
)
# ----------------------------------------------------------------------------------------


def _set(words: str) -> frozenset[str]:
    return frozenset(words.split())


@dataclass(frozen=True)
class ScriptProfile:
    """What segmentation has to know about a script.

    ``delimiters`` end parts, ``separator`` stands between syllables.  ``script`` and
    ``foreign`` are character classes: a segment with foreign and no script characters is
    dropped.  A boundary is strong by ``strong_chars`` (any one), ``strong_runs`` (so many of
    one character); ``always`` makes every boundary strong.
    """

    name: str
    delimiters: str
    separator: str
    script: str
    foreign: str
    strong_chars: str = ""
    strong_runs: tuple[tuple[str, int], ...] = ()
    always: bool = False
    terminators: frozenset[str] = frozenset()
    optatives: frozenset[str] = frozenset()
    sentence_initial: frozenset[str] = frozenset()
    blocking: frozenset[str] = frozenset()
    correlative_first: frozenset[str] = frozenset()
    correlative_second: frozenset[str] = frozenset()
    continuators: frozenset[str] = frozenset()
    section_markers: frozenset[str] = frozenset()
    digits: str = ""


TIBETAN = ScriptProfile(
    name="tibetan",
    delimiters=SHAD + DOUBLE_SHAD + TER_TSHEG,
    separator=TSHEG,
    script=r"ༀ-࿿",
    foreign="a-zA-Z",
    strong_chars=DOUBLE_SHAD,
    strong_runs=((TER_TSHEG, 2), (SHAD, 4)),
    terminators=_set(TERMINATORS),
    optatives=_set(OPTATIVES),
    sentence_initial=_set(SENTENCE_INITIAL),
    blocking=_set(GERUNDS) | _set(PARTICLES) | _set(ADVERBIALIZERS) | _set(TOPICS),
    correlative_first=_set(CORRELATIVE_FIRST),
    correlative_second=_set(CORRELATIVE_SECOND),
    continuators=_set(CONTINUATORS),
    section_markers=_set(SECTION_MARKERS),
    digits=r"༠-༩",
)

#: Latin prose: every run of sentence punctuation is a boundary, spaces part words.
LATIN = ScriptProfile(
    name="latin", delimiters=".!?", separator=" ", script="a-zA-Z", foreign=r"ༀ-࿿", always=True, digits="0-9"
)

PROFILES = {p.name: p for p in (TIBETAN, LATIN)}
