"""Word lists, patterns and limits of the text operators.

Fixed values: results depend on exactly these entries. Every operator takes its lists as
parameters; these are the defaults.
"""

from __future__ import annotations

import re

# section header phrases
MUST_HEADERS = [
    "requirements", "required", "must have", "what you bring", "your profile", "qualification", "qualifications",
    "we expect", "pozadujeme", "poziadavky", "musite mat", "vyzadujeme", "profil kandidata", "minimum qualifications",
]
NICE_HEADERS = [
    "nice to have", "preferred", "bonus", "plus", "advantage", "vyhodou je", "ocenime", "preferred qualifications",
]

# cues for the priority of one line
MUST_CUES = [
    "must", "required", "need to", "we require", "mandatory", "vyzadujeme", "pozadujeme", "nutne", "musi mat",
]
NICE_CUES = ["nice to have", "preferred", "bonus", "plus", "advantage", "ocenime", "vyhodou je", "preferovane"]

# category patterns on lower-case lines
HARD_SKILL_PATTERNS = [
    r"\bpython\b", r"\btypescript\b", r"\bsql\b", r"\bjava\b", r"\bc\+\+\b", r"\bmachine learning\b", r"\bml\b", r"\bllm\b",
    r"\brag\b", r"\bgenerative ai\b", r"\bdeep learning\b", r"\bstatistics\b", r"\bdata science\b", r"\bpower bi\b",
    r"\bexcel\b", r"\baws\b", r"\bazure\b", r"\bgcp\b", r"\bdocker\b", r"\bkubernetes\b", r"\bci/cd\b", r"\bgit\b",
    r"\belasticsearch\b", r"\blogstash\b", r"\bgrafana\b", r"\bkibana\b", r"\bapi\b", r"\brest\b", r"\bscikit-learn\b",
    r"\bxgboost\b", r"\bpandas\b", r"\bnumpy\b", r"\bpolars\b",
]
EDUCATION_PATTERNS = [
    r"\bbachelor", r"\bmaster", r"\bdoctorate", r"\bphd", r"\bdegree\b", r"\buniversity\b", r"\bcomputer science\b",
    r"\bdata science\b", r"\bapplied mathematics\b", r"\bstatistics\b", r"\bphysics\b", r"\bvysokoskolske\b",
    r"\bvzdelanie\b", r"\btitul\b", r"\bfaculty\b",
]
LANGUAGE_PATTERNS = [
    r"\benglish\b", r"\banglick", r"\bgerman\b", r"\bnemeck", r"\bfrench\b", r"\bczech\b", r"\bslovak\b", r"\bb2\b",
    r"\bc1\b", r"\bupper intermediate\b", r"\badvanced\b", r"\bfluent\b",
]
LOCATION_PATTERNS = [
    r"\bbratislava\b", r"\bslovakia\b", r"\bhybrid\b", r"\bon-site\b", r"\bremote\b", r"\bhome office\b",
    r"\bmlynske nivy\b", r"\btwin city\b",
]
SOFT_SKILL_PATTERNS = [
    r"\bcollaborative\b", r"\bteam\b", r"\bcommunication\b", r"\bagile\b", r"\borchestration\b", r"\bplanning\b",
    r"\bcuriosity\b", r"\bproblem solving\b", r"\bmentor", r"\bleadership\b", r"\bscaled agile\b",
]
YEARS_PATTERNS = [r"\b\d+\+?\s*(?:year|years|rok|roky)\b"]

# words that make a line a job title
ROLE_WORDS = ["engineer", "scientist", "developer", "analyst", "manager", "specialist"]

# requirement keys: whole-text synonyms, phrases to leave out (in this order), whole-text aliases
SYNONYMS = {
    "programovanie v jazyku python": "python",
    "skusenosti s pythonom": "python",
    "pokrocila znalost python": "python",
    "znalost python": "python",
    "programovanie v jazyku java": "java",
    "skusenosti s javou": "java",
    "znalost sql": "sql",
    "skusenosti so sql": "sql",
    "anglicky jazyk": "anglictina",
    "anglictina b2": "anglictina na urovni b2",
    "english b2": "anglictina na urovni b2",
    "timova praca": "teamova spolupraca",
    "praca v time": "teamova spolupraca",
    "ms office": "microsoft office",
    "ms excel": "microsoft excel",
    "microsoft excel": "microsoft excel",
    "excel": "microsoft excel",
    "aj": "anglictina",
    "nj": "nemcina",
}
STOP_PHRASES = [
    "znalost", "prakticka znalost", "pokrocila znalost", "vyborna znalost", "zakladna znalost", "skusenosti s",
    "skusenost s", "prax s", "prax v", "schopnost", "schopnost pracovat s", "ovladanie", "aktivna", "vyhodou je",
    "podmienkou je", "skusenosti v oblasti",
]
ALIASES = {
    "python developer": "python",
    "python vyvoj": "python",
    "rest apis": "rest api",
    "api": "api",
    "sql databazy": "sql",
    "english language": "anglictina",
    "nemecky jazyk": "nemcina",
}

# key -> (canonical key, canonical text, category); degrees count as education
CANONICAL = {
    "python": ("python", "Python", "hard_skill"),
    "java": ("java", "Java", "hard_skill"),
    "sql": ("sql", "SQL", "hard_skill"),
    "rest api": ("rest api", "REST API", "hard_skill"),
    "docker": ("docker", "Docker", "hard_skill"),
    "kubernetes": ("kubernetes", "Kubernetes", "hard_skill"),
    "git": ("git", "Git", "hard_skill"),
    "linux": ("linux", "Linux", "hard_skill"),
    "aws": ("aws", "AWS", "hard_skill"),
    "azure": ("azure", "Azure", "hard_skill"),
    "sap successfactors": ("sap successfactors", "SAP SuccessFactors", "hard_skill"),
    "microsoft excel": ("microsoft excel", "Microsoft Excel", "hard_skill"),
    "microsoft office": ("microsoft office", "Microsoft Office", "hard_skill"),
    "anglictina": ("anglictina", "anglicky jazyk", "language"),
    "anglictina na urovni b2": ("anglictina na urovni b2", "anglictina na urovni B2", "language"),
    "anglicky jazyk": ("anglictina", "anglicky jazyk", "language"),
    "anglicky jazyk na urovni b2": ("anglictina na urovni b2", "anglictina na urovni B2", "language"),
    "nemcina": ("nemcina", "nemcina", "language"),
    "teamova spolupraca": ("timova spolupraca", "teamova spolupraca", "soft_skill"),
    "timova spolupraca": ("timova spolupraca", "teamova spolupraca", "soft_skill"),
    "komunikacne schopnosti": ("komunikacne schopnosti", "komunikacne schopnosti", "soft_skill"),
    "samostatnost": ("samostatnost", "samostatnost", "soft_skill"),
    "zodpovednost": ("zodpovednost", "zodpovednost", "soft_skill"),
    "bratislava": ("bratislava", "Bratislava", "location"),
    "2.stupna": ("magisterske", "inzinierske", "education"),
    "1.stupna": ("bakalarske", "bakalar", "education"),
    "3.stupna": ("doktorand", "doktorandke", "education"),
    "data engineer": ("data warehouse experience", "data engineering", "hard_skill"),
    "presentation skills": ("customer facing position", "stakeholder presentation", "soft_skill"),
    "prezentacne schopnosti": ("customer facing position", "stakeholder presentation", "soft_skill"),
}

# parts of a key that speak for a general or for a concrete requirement
GENERIC_PARTS = [
    "komunikacne schopnosti", "komunikacia", "samostatnost", "zodpovednost", "flexibilita", "odolnost voci stresu",
    "teamova spolupraca", "teamovy hrac", "proaktivny pristup", "motivacia", "ucit sa nove veci",
    "prijemne vystupovanie", "spolahlivost",
]
CONCRETE_PARTS = [
    "python", "java", "sql", "excel", "microsoft excel", "docker", "kubernetes", "linux", "aws", "azure", "sap",
    "rest api", "api", "git", "b1", "b2", "c1", "c2", "bratislava", "praxe", "rok", "roky", "certifikat", "vzdelanie",
    "bakalar", "magister",
]

# known categories and priorities
CATEGORIES = ["hard_skill", "experience", "education", "language", "soft_skill", "location", "other"]
PRIORITIES = ["must", "nice", "unknown"]


EDGE, WORD = r"[^\p{L}\p{N}_]", r"[\p{L}\p{N}_]"


def portable_pattern(pattern: str) -> tuple[str, str, str]:
    r"""(start, core, end) of a pattern with Unicode word boundaries spelled out.

    Java and RE2 have no common ``\b``. Behind a sign such as ``+`` a boundary needs a word
    character, as it does in the original.
    """
    core = pattern.replace(r"\d", r"\p{Nd}")
    start = rf"(?:^|{EDGE})" if core.startswith(r"\b") else ""
    core, end = core.removeprefix(r"\b"), ""
    if core.endswith(r"\b"):
        core = core.removesuffix(r"\b")
        end = rf"(?:$|{EDGE})" if core[-1].isalnum() or core[-1] == ")" else WORD
    return start, core, end


def java_pattern(patterns: list[str]) -> str:
    """The same as ``any_pattern`` for Java: plain texts are looked for by their rare letters (see ``any_text``).

    For others a place is left at once unless one of them may begin there.
    """
    texts: list[tuple[str, str, str]] = []
    groups: dict[tuple[str, str], list[str]] = {}
    for pattern in patterns:
        start, core, end = portable_pattern(pattern)
        behind = rf"(?<!{WORD})" if start else ""
        after = rf"(?!{WORD})" if end.startswith("(?:$") else f"(?={WORD})" if end else ""
        plain = re.sub(r"\\([^a-zA-Z0-9])", r"\1", core)
        if plain and re.fullmatch(r"(?:[a-zA-Z0-9 /-]|\\[^a-zA-Z0-9])+", core):
            texts.append((plain, behind, after))
        else:
            groups.setdefault((behind, after), []).append(core)
    rest = [f"{first_letters(cores)}{behind}(?:{'|'.join(cores)}){after}" for (behind, after), cores in groups.items()]
    return "|".join([any_text(texts)] * bool(texts) + rest)


#: Letters by how often texts have them, per mille of an English text; signs and digits count as rare, blanks as the most frequent.
LETTERS = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (127, 91, 82, 75, 70, 67, 63, 61, 60, 43, 40, 28, 28, 24, 24, 22, 20, 20, 19, 15, 10, 8, 2, 2, 1, 1), strict=True)) | {" ": 180}


def any_text(texts: list[tuple[str, str, str]]) -> str:
    """Java pattern for one of some (text, pattern before it, pattern behind it).

    Every text has a character that is rare among all, and is only looked at where that stands. Trying all texts at
    every place where one may begin takes several times as long. Letters decide the time only.
    """
    often = lambda c: LETTERS.get(c, 1)
    marks: set[str] = set()
    while left := [t for t, _, _ in texts if not marks & set(t)]:
        marks.add(min(sorted(set("".join(left))), key=lambda c: often(c) / sum(c in t for t in left)))
    for c in sorted(marks, key=lambda c: (-often(c), c)):
        if all(set(t) & (marks - {c}) for t, _, _ in texts):
            marks.discard(c)
    by_mark: dict[str, list[tuple[str, str]]] = {}
    for text, behind, after in sorted(set(texts)):
        mark = min(sorted(set(text) & marks), key=often)
        at = text.index(mark)
        before = f"(?<={behind}{quoted(text[:at + 1])})" if at or behind else ""
        by_mark.setdefault(mark, []).append((text[at + 1:], f"{before}{quoted(text[at + 1:])}{after}"))

    def look(chars: set[str]) -> str:
        return f"(?=[{''.join(quoted(c) for c in sorted(chars))}])"

    def rest(mark: str) -> str:
        tails = by_mark[mark]
        following = look({t[0] for t, _ in tails}) if all(t for t, _ in tails) else ""
        return f"{quoted(mark)}{following}(?:{'|'.join(p for _, p in tails)})"

    def halves(own: list[str]) -> str:
        if len(own) <= 2:
            return "|".join(rest(m) for m in own)
        return f"{look(set(own[:len(own) // 2]))}(?:{halves(own[:len(own) // 2])})|{halves(own[len(own) // 2:])}"

    return f"{look(marks)}(?:{halves(sorted(marks))})"


def quoted(text: str) -> str:
    """Pattern for a text, in or outside a class."""
    return "".join(c if c.isalnum() or not c.isascii() else f"\\{c}" for c in text)


def first_letters(cores: list[str]) -> str:
    """Look-ahead for the first characters of patterns; nothing if one begins with a sign that may stand for others."""
    first = sorted({c[0] for c in cores})
    if all(x.isascii() and x.isalnum() for x in first):
        return f"(?=[{''.join(first)}])"
    return r"(?=[0-9\p{Nd}])" if all(c.startswith(r"\p{Nd}") for c in cores) else ""


def any_pattern(patterns: list[str]) -> str:
    """One pattern for a list; patterns with the same boundaries share them, so that a position
    that is no word start is left after one look."""
    groups: dict[tuple[str, str], list[str]] = {}
    for pattern in patterns:
        start, core, end = portable_pattern(pattern)
        groups.setdefault((start, end), []).append(core)
    return "|".join(f"{start}(?:{'|'.join(cores)}){end}" for (start, end), cores in groups.items())
