"""A plain company matcher, one cell and one variant at a time, to hold the columns against."""

import re
from itertools import product

from lexmill.functions.company import ALIASES, CANONICAL, OTHER_SUFFIXES, SOFT_TOKENS, letters, normalize, split_suffix, winkler


def runs_joined(tokens):
    """The tokens, and for each maximal run of two or more single letters the tokens with that run as one, plain and with points."""
    out, i = [tokens], 0
    while i < len(tokens):
        j = i
        while j < len(tokens) and len(tokens[j]) == 1 and tokens[j].isalpha():
            j += 1
        if j - i > 1:
            out += [tokens[:i] + [x] + tokens[j:] for x in ("".join(tokens[i:j]), ".".join(tokens[i:j]) + ".")]
        i = max(j, i + 1)
    return out


def variants(query):
    normal = normalize(query)
    core, suffix = split_suffix(normal)
    ends = [suffix, *OTHER_SUFFIXES.get(suffix, ())] if suffix else []
    out = [normal]
    for tokens in runs_joined(core.split()) if core else []:
        ways = [[t, " ".join(t), ".".join(t) + "."] if 2 <= len(t) <= 3 and t.isalpha() and t in core.split() else [t] for t in tokens]
        for way in product(*ways):
            out += [f"{' '.join(way)} {e}".strip() for e in (*ends, "")]
    return list(dict.fromkeys(" ".join(x.split()) for x in out if x.strip())), normal, core, suffix


def present(token, among):
    meant = {CANONICAL.get(a, a) for a in (token, *ALIASES.get(token, ()))}
    return any(CANONICAL.get(m, m) in meant or (len(token) > 4 < len(CANONICAL.get(m, m)) and token.rstrip("S") == CANONICAL.get(m, m).rstrip("S")) for m in among)


class Plain:
    def __init__(self, query, accept=92):
        self.variants, self.normal, self.core, suffix = variants(query)
        self.accept, self.tokens = accept, self.core.split()
        self.equals = [letters(normalize(v)) for v in self.variants + ([f"{self.core} LIMITED", f"{self.core} LTD"] if suffix == "PRIVATE LIMITED" else [])]
        self.tests = []
        for v in self.variants:
            words = ["(?:" + "|".join(map(re.escape, ALIASES.get(w, (w,)))) + ")" for w in normalize(v).split()]
            self.tests.append((re.compile(r"(?<![A-Z0-9])" + r"[\W_]+".join(words) + r"(?![A-Z0-9])", re.I) if words else re.compile(r"$^"), v))
        self.cores = [split_suffix(normalize(v))[0].split() for v in self.variants]

    def best(self, value):
        own = letters(normalize(normalize(value)))
        return max((winkler(own, e) for e in self.equals), default=0)

    def decide(self, cell):
        """(matched, score, method, candidate, variant)"""
        if not cell:
            return False, 0, "empty", "", ""
        for test, v in self.tests:
            if test.search(cell):
                return True, max(95, self.best(cell)), "variant_regex", cell, v
        quoted = re.findall('"([^"]+)"', cell)
        names = [cell, *(quoted or (cell.split(",") if "," in cell else []))]
        for name in dict.fromkeys(" ".join(n.upper().split()) for n in names if n.strip()):
            normal = normalize(name)
            if not normal:
                continue
            among = split_suffix(normal)[0].split()
            if self.tokens and among and any(c and (" ".join(c) in " ".join(among) or all(present(t, among) for t in c)) for c in self.cores):
                return True, max(90, self.best(normal)), "core_tokens", normal, self.core
            hard = [t for t in self.tokens if t not in SOFT_TOKENS]
            need = hard if len(hard) > 1 else self.tokens
            if self.best(normal) >= self.accept and sum(present(t, among) for t in need) >= 0.75 * len(need):
                return True, self.best(normal), "jaro_winkler", normal, self.normal
        return False, self.best(cell), "no_match", "", ""
