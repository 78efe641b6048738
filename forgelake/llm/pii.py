"""Personal information in free text, found by a semi-Markov conditional random field.

Whole spans are the unit. Patterns propose candidate segments of bounded length,
tight and loose ones that overlap; what a pattern is called is a feature of the
span, beside its shape, its neighbours and the field. A segmentation is a
sequence of segments that don't overlap, its score the sum of its segments'
scores and of the transitions between the types that follow each other; text
outside segments scores zero. A dynamic programme over segment boundaries sums
over all segmentations (`marginals`) and finds the best one (`best_segments`), so
boundaries and types are chosen jointly. The weights maximise the conditional
likelihood of a bounded sample of labelled sentences that is made by rule
(`labelled`). A lexicon of name parts, counted over the author fields of all
rows, is a feature.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.errors import LayoutError

TYPES = ("email", "phone", "id_number", "address", "name")

#: Labelled sentences that the weights are fitted on, and rounds over them.
SAMPLE, ROUNDS = 4000, 5

#: Step and penalty of the fit.
STEP, PENALTY = 0.5, 1e-4

#: Name parts that a table may have; none is left out, more are an error.
MAX_PARTS = 5_000_000

_U = "A-ZÀ-ÖØ-ÞĀĂĄĆĈĊČĎĐĒĔĖĘĚĜĞĠĢĤĦĨĪĬĮİĴĶĹĻĽŁŃŅŇŌŎŐŒŔŖŘŚŜŞŠŢŤŦŨŪŬŮŰŲŴŶŸŹŻŽ"
_CAP = rf"[{_U}][\w]*(?:['’-][\w]+)*"
_CITY = rf"{_CAP}(?: {_CAP}){{0,2}}"
_STREET = r"(?:Street|St\.?|Road|Rd\.?|Lane|Ln\.?|Avenue|Ave\.?|Blvd\.?|Boulevard|Court|Ct\.?|Close|Drive|Dr\.?|Way|Place|Square|Terrace|Crescent|Row|Hill|Walk)"
_NO = r"(?<![\w.#/@-])"
_END = r"(?![\w]|[-/.:]\w)"

#: variant, type, pattern. A lookahead lets candidates overlap.
CANDIDATES = [(v, t, re.compile(p)) for v, t, p in (
    ("plain", "email", r"(?<![\w.+%-])(?=([A-Za-z0-9][\w.+%-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+))"),
    ("spelled", "email", r"(?<![\w.+%-])(?=([A-Za-z0-9][\w.+%-]*\s?(?:[\[({<]\s?(?:at|AT|At)\s?[\])}>]|\s(?:at|AT)\s)\s?[A-Za-z0-9-]+(?:(?:\s?[\[({<]\s?(?:dot|DOT)\s?[\])}>]\s?|\s(?:dot|DOT)\s|\.)[A-Za-z0-9-]+)+))"),
    ("intl", "phone", r"(?<![\w.])(?=(\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ ./-]?\d{1,6}){2,6}(?:,? ?(?:ext\.?|x)\s?\d{1,5})?))"),
    ("nanp", "phone", _NO + r"(?=(\(?\d{3}\)?[ .-]\d{3}[.-]\d{4}(?:,? ?(?:ext\.?|x)\s?\d{1,5})?)" + _END + ")"),
    ("trunk", "phone", _NO + r"(?=(0\d{1,4}(?:[ /.-]\d{2,8}){1,5})" + _END + ")"),
    ("ssn", "id_number", _NO + r"(?=(\d{3}[- ]\d{2}[- ]\d{4})" + _END + ")"),
    ("dated", "id_number", _NO + r"(?=(\d{6}-\d{4})" + _END + ")"),
    ("letters", "id_number", r"(?<![\w.#/@-])(?=([A-Z]{1,2}\d{7,9})" + _END + ")"),
    ("card", "id_number", r"(?<![\w.#/@-])(?=(\d{8}[A-Z])" + _END + ")"),
    ("plain_digits", "id_number", _NO + r"(?=(\d{9}|\d{11}|\d{12})" + _END + ")"),
    ("bank", "id_number", r"(?<![\w.#/@-])(?=([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)" + _END + ")"),
    ("payment", "id_number", _NO + r"(?=(\d{4}(?:[ -]\d{4}){3})" + _END + ")"),
    ("plain_phone", "phone", _NO + r"(?=(\d{10,11})" + _END + ")"),
    ("loose", "address", rf"(?<![\w.#/@-])(?=(\d{{1,4}}[A-Za-z]? {_CAP}(?: {_CAP}){{1,2}}, {_CITY}))"),
    ("english", "address", rf"(?<![\w.#/@-])(?=((?:(?:Flat|Unit|Apt\.?|Suite) \w{{1,5}}, )?\d{{1,4}}[A-Za-z]? (?:{_CAP} ){{1,3}}{_STREET}(?:, (?:Flat|Unit|Apt\.?|Suite) \w{{1,5}})?(?:, (?:\d{{4,5}} )?{_CITY}(?: \d{{4,5}})?)?))"),
    ("german", "address", rf"(?<![\w.#/@-])(?=((?:(?:Alte|Neue|Am|An der|Im|Zur|Zum) )?[{_U}]\w*(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|ufer|damm) \d{{1,4}}[a-z]?(?:, (?:\d{{5}} )?{_CITY})?))"),
    ("posted", "address", rf"(?<![\w.#/@-])(?=({_CAP} \d{{1,4}}[a-z]?, \d{{4,5}} {_CITY}))"),
    ("french", "address", rf"(?<![\w.#/@-])(?=(\d{{1,4}},? (?:rue|avenue|boulevard|place|chemin|allée|quai|impasse) (?:de la |de l'|du |des |de |d')?{_CAP}(?: {_CAP}){{0,3}}(?:, (?:\d{{5}} )?{_CITY})?))"),
    ("spanish", "address", rf"(?<![\w.#/@-])(?=((?:Calle|Avenida|Plaza|Paseo|Camino|Carrera) (?:de la |de los |de las |del |de )?{_CAP}(?: {_CAP}){{0,3}},? \d{{1,4}}(?:, (?:\d{{5}} )?{_CITY})?))"),
    ("pair", "name", rf"(?<![\w@/#`.&+-])(?=({_CAP} (?:[A-Z]\. )?{_CAP})(?![\w@]))"),
    ("turned", "name", rf"(?<![\w@/#`.&+-])(?=({_CAP}, {_CAP})(?![\w@]))"),
)]

#: What a text must hold for the candidates of a variant to be looked for; cheaper to find than they are.
GATES = {v: re.compile(p) for v, p in {
    "plain": "@", "spelled": r"[\[({<]\s?(?:at|At|AT)\b|\b(?:at|AT) [A-Za-z0-9-]+ (?:dot|DOT)\b", "intl": r"\+\d", "nanp": r"\d{3}[.-]\d{4}", "trunk": r"0\d{1,4}[ /.-]\d\d", "ssn": r"\d[- ]\d\d[- ]\d{4}", "dated": r"\d{6}-\d{4}",
    "plain_digits": r"\d{9}", "bank": r"[A-Z]{2}\d{2} ?[A-Z0-9]{4}", "payment": r"\d{4}[ -]\d{4}[ -]\d{4}", "plain_phone": r"\d{10}", "loose": rf"\d[A-Za-z]? [{_U}]", "letters": r"[A-Z]\d{7}", "card": r"\d{8}[A-Z]", "english": rf"\d[A-Za-z]? [{_U}]", "german": r"(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|ufer|damm) \d", "posted": r"\d[a-z]?, \d{4,5} ", "french": r"\d,? (?:rue|avenue|boulevard|place|chemin|allée|quai|impasse) ",
    "spanish": r"(?:Calle|Avenida|Plaza|Paseo|Camino|Carrera) ", "pair": rf"[{_U}][\w'’-]* (?:[A-Z]\. )?[{_U}]", "turned": rf"[{_U}][\w'’-]*, [{_U}]",
}.items()}

_CAP_BEFORE, _CAP_BEHIND = re.compile(rf"(?<![\w])[{_U}]\w+ (?:\d+ )?$"), re.compile(rf" (?:\d+ )?[{_U}]\w+(?!\w|[.,:])")

_WORD = re.compile(r"[\w']+|[^\w\s]")


class Lexicon:
    """How often a word stands as first and as last part of a person's name, in lower case."""

    def __init__(self, first: dict[str, int], last: dict[str, int]):
        self.first, self.last = first, last


def features(text: str, start: int, end: int, variant: str, kind: str, field: str, lexicon: Lexicon) -> list[str]:
    """The features of one candidate segment."""
    span = text[start:end]
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 40):start].rpartition("\n")[2])][-3:]
    after = [w.lower() for w in _WORD.findall(text[end:end + 24].partition("\n")[0])][:2]
    at_line = not text[:start].rpartition("\n")[2].strip(" \t>-—*")
    to_line = not text[end:].partition("\n")[0].strip()
    out = [f"{kind}|{variant}", f"{kind}|{variant}|field={field}", f"{kind}|R1={after[0] if after else '$'}", f"{kind}|line={at_line}{to_line}"]
    out += [f"{kind}|L1={before[-1] if before else '^'}"] + [f"{kind}|L={w}" for w in set(before)]
    if kind == "email":
        domain = re.split(r"@|\b(?:at|AT|At)\b", span, maxsplit=1)[-1]
        out += [f"email|top={'letters' if re.search(r'[A-Za-z]{2,}$', domain) else 'other'}", f"email|path={bool(re.match(r':[^/ ]', text[end:end + 2]))}", f"email|number={bool(re.fullmatch(r'[0-9.]+', domain))}"]
    elif kind in ("phone", "id_number"):
        digits = re.sub(r"\D", "", span)
        shape = re.sub(r"\d", "9", re.sub(r"[A-Z]", "A", re.sub(r"(?:ext\.?|x)\s?\d+$", "", span).strip()))
        out += [f"{kind}|shape={shape}", f"{kind}|n={min(len(digits), 16)}", f"{kind}|{variant}|lead={digits[:1]}", f"{kind}|fiction={bool(re.search(r'555.?01', span))}", f"{kind}|{variant}|letter={span[0] if span[0].isalpha() else ''}"]
    elif kind == "address":
        out += [f"address|{variant}|city={',' in re.sub(r'^(?:Flat|Unit|Apt|Suite)[^,]*,', '', span)}", f"address|post={bool(re.search(r'\d{5}', span))}"]
    else:
        first, last = (span.split(", ")[::-1] if variant == "turned" else (span.split(" ")[0], span.split(" ")[-1]))
        known = (lexicon.first.get(first.lower(), 0) > 1, lexicon.last.get(last.lower(), 0) > 1)
        beside = (bool(_CAP_BEFORE.search(text, max(0, start - 30), start)), bool(_CAP_BEHIND.match(text, end)))
        out += [f"name|run={beside[0]}{beside[1]}|known={known[0]}{known[1]}", f"name|{variant}|known={known[0]}{known[1]}", f"name|swapped={lexicon.last.get(first.lower(), 0) > 1}{lexicon.first.get(last.lower(), 0) > 1}", f"name|initial={'. ' in span}", f"name|length={len(first) > 2}{len(last) > 2}", f"name|known={known[0]}{known[1]}|L1={before[-1] if before else '^'}"]
    return out


def candidates(text: str, field: str, lexicon: Lexicon) -> list[tuple[int, int, str, list[str]]]:
    """start, end, type and features of each candidate; whole texts are searched."""
    out = []
    for variant, kind, pattern in CANDIDATES:
        if not GATES[variant].search(text):
            continue
        for m in pattern.finditer(text):
            start, end = m.span(1)
            if kind == "phone" and not 7 <= sum(c.isdigit() for c in m.group(1)) <= 18:
                continue
            ends = [end]
            if kind == "address":  # words behind a comma may be a town and what follows it
                tail = m.group(1).rpartition(", ")[2]
                ends += [end - len(tail) + x.start() for x in re.finditer(" ", tail)] if m.group(1).count(", ") and not tail[0].isdigit() else []
                ends += [end - len(tail) + x.start() for x in list(re.finditer(" ", tail))[1:]] if tail[:1].isdigit() and tail[:4].isdigit() else []
            for e in ends:
                out.append((start, e, kind, features(text, start, e, variant, kind, field, lexicon)))
    return out


Candidate = tuple[int, int, str, list[str]]
_LABELS = ("^", *TYPES)


def _scored(found: list[Candidate], weights: dict[str, float]) -> list[float]:
    get = weights.get
    return [sum([get(x, 0.0) for x in f]) for _, _, _, f in found]


def best_segments(found: list[Candidate], weights: dict[str, float]) -> list[Candidate]:
    """The segmentation of highest score: segments that don't overlap, with the transitions between their types."""
    scores = _scored(found, weights)
    order = sorted(range(len(found)), key=lambda i: found[i][:2])
    ending = sorted(order, key=lambda i: found[i][1])
    value, back, e = [0.0] * len(found), [-1] * len(found), 0
    top: dict[str, tuple[float, int]] = {"^": (0.0, -1)}
    for i in order:
        start, _, kind, _ = found[i]
        while e < len(ending) and found[ending[e]][1] <= start:
            j = ending[e]
            if found[j][2] not in top or value[j] > top[found[j][2]][0]:
                top[found[j][2]] = (value[j], j)
            e += 1
        best = max(((v + weights.get(f"{label}>{kind}", 0.0), j) for label, (v, j) in top.items()), key=lambda x: x[0])
        value[i], back[i] = best[0] + scores[i], best[1]
    at = max(range(-1, len(found)), key=lambda i: value[i] if i >= 0 else 0.0)
    out = []
    while at >= 0:
        out.append(found[at])
        at = back[at]
    return out[::-1]


def _log_sum(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


def marginals(found: list[Candidate], weights: dict[str, float]) -> tuple[float, list[float], dict[str, float]]:
    """The log partition function, the probability of each candidate, and the expected number of each transition, by the forward and backward recursions over boundaries."""
    scores = _scored(found, weights)
    order = sorted(range(len(found)), key=lambda i: found[i][:2])
    ending = sorted(order, key=lambda i: found[i][1])
    t = {(a, b): weights.get(f"{a}>{b}", 0.0) for a in _LABELS for b in TYPES}
    forward, backward, e = [0.0] * len(found), [0.0] * len(found), 0
    before: list[dict[str, float]] = [{}] * len(found)
    held: dict[str, list[float]] = {"^": [0.0]}
    for i in order:
        while e < len(ending) and found[ending[e]][1] <= found[i][0]:
            held.setdefault(found[ending[e]][2], []).append(forward[ending[e]])
            e += 1
        before[i] = {a: _log_sum(xs) + t[a, found[i][2]] for a, xs in held.items()}
        forward[i] = _log_sum(list(before[i].values())) + scores[i]
    z = _log_sum([0.0, *forward])
    later: dict[str, list[float]] = {}
    e = len(order) - 1
    for i in reversed(ending):
        while e >= 0 and found[order[e]][0] >= found[i][1]:
            j = order[e]
            later.setdefault(found[j][2], []).append(scores[j] + backward[j])
            e -= 1
        backward[i] = _log_sum([0.0, *(t[found[i][2], b] + x for b, xs in later.items() for x in xs)])
    moves: dict[str, float] = defaultdict(float)
    for i in order:
        for a, x in before[i].items():
            moves[f"{a}>{found[i][2]}"] += math.exp(x + scores[i] + backward[i] - z)
    return z, [math.exp(f + b - z) for f, b in zip(forward, backward)], moves


# Labelled sentences: a value in braces is an item of that type; `{x:...}` builds look-alikes that are none.
_SAID = {
    "email": ["My old address {} no longer works.", "Please send the dump to {}.", "Contact: {}", "({}, in case the bot loses this)", "You can reach me at {} if the thread goes quiet.", "Logs show login={} right before the crash.", "bounce from {}", "The row `7;open;{}` should be masked.", '{"reporter": "{}", "retries": 3}', "Schreib mir bitte an {}.", "Escríbeme a {}, por favor.", "Forwarded from {}, see below.", "Signed-off-by: {name} <{}>", "{name} <{}>", "Please add {name} ({}) to the reviewers.", "{}", "Mail mailto:{} for access."],
    "phone": ["My number is {}.", "Call me on {}, this cannot wait.", "Mobile: {}", "Tel {}", "The on-call phone is {} during the weekend.", "I left a voicemail at {} yesterday.", "The link tel:{} is dead.", "Text messages to {} work too.", "Appelez le {} en cas d'urgence.", "Rufnummer {}, am besten vormittags.", "caller={} result=busy", "{}", "Phone: {}"],
    "id_number": ["The test row holds a real SSN, {}.", "Validation rejects {}, which is what my card says.", "Applicant {} appears twice in the export.", "Why does the log print taxpayer {}?", "The form leaked my passport {} into the log.", "For the access request: national id no. {}.", "Screenshot shows identity card: {}, please remove it.", "ssn={} status=kept", "For the access request: SSN no. {}.", "My passport number is {}.", "SSN: {}", "passport {}", "my card number {} was in the dump", "IBAN {} is printed twice", "national id {}"],
    "address": ["I live at {} and the map pin is off.", "Ship the test board to {}.", "Our office moved to {} last month.", "Postal address: {}", "The invoice still prints {}.", 'The payload still has "ship_to": "{}" from my order.', "Wir sitzen jetzt in {}.", "Geocoding {} gives the wrong result, and yes, I live there.", "{}", "{} {name}", "I live at {} {name} says."],
    "name": ["Ask {}, who wrote the first version.", "Credit goes to {} for the first draft.", "I talked to {} about it last week.", "Merci à {} pour la relecture.", "Gracias a {} por la ayuda.", "Kind regards, {}", "— {}", "{}", "`@author {}` is wrong, it was my patch.", "| owner | {} |", "As {} wrote on the list, this is intended.", "Reviewed-by: {}", "briskforge ({})", "Danke an {} für den Hinweis.", "cc {} from the other team.", "It is fixed. {}\n{address}\nMobile: {phone}", "{}\n{address}\nTel {phone}\nThe loader drops it.", "Kind regards,\n{}\nThe loader drops it."],
}
_UNSAID = ["The serial X{d9} on the box has nothing to do with it.", "The serial X{d8} on the box is old.", "The serial X{d7} on the box has nothing to do with it.", "Serial number AB{d7} is printed below.", "The menu now shows Home, Docs, Pricing and Blog in that order.", "Languages: French, German, Spanish", "Company | Blog Coverage changed by 0.{d1} percent.", "Home Docs Pricing The stack ends here.", "Boards Reviewed as planned", "Impressum Datenschutz Der Fehler tritt auf.", "Settings Right. Packages All checks passed", "Issues Changes Please rerun it", "Trace id {d3}-{d3}-{d4} shows the row.", "Trace id 40{d1}-77{d1}-{d4} shows the cold row.", "Rack label 4{d2}-{d2}-{d4} points at the wrong shelf, the job runner is on part 3{d2}-0{d1}-{d4}.", "Build 2023{d2}.{d3} finished in {d2}m, exit status 0.", "Order number {d8} in the fixture is only sample data.", "Section {d2} Road map and chapter {d2} Drive letters need a rewrite.", "Milestone {d2} High Street is the code name of the map work, not a place.", "The board shows {d2} Fast Lane tickets and {d2} Main Road blockers for the parser.", "Release Amber Finch ships the new loader, Silent Falcon will drop the old one.", "The Blue Harbor theme and the Iron Meadow theme share the parser.", "Clone it with git@forge.example:calm{d1}/relay.git and run it.", "Pin lark-probe@{d1}.{d1}.{d1} until the parser is fixed.", "The decorator @guard_mint hides the signature.", "It listens on 10.0.{d2}.{d2}:80{d2} and on nothing else.", "Copyright 20{d2} Codeharbor Ltd. All rights reserved.", "Merge Queue Pipelines Wiki Insights", "Home Projects Issues {d2} Changes", "Packages People Activity Search", "Der Fehler tritt mit Version {d1}.{d2} auf.", "Der Commit {d8} ist falsch.", "Kind regards, The Team", "We look at it at home dot files.", "Look at the page, at line {d3}.", "Line {d3} prints 00:00:00.{d3} and 1e-7, so the clock is fine.", "Terms Privacy", "About Us Press Careers", "I talked to Blue Harbor about it.", "See Amber Finch, who wrote it.", "Got it Accept All", "Our Team Runs", "Powered by Codeharbor 1.2.3 Site Map Press", "Error {d3}-{d2}-{d4} in module", "sku {d3}-{d2}-{d4}", "commit {d6}-{d4} of the batch", "Part AB{d7} is worn", "job {d9} was queued", "run {d10} failed after {d11} bytes", "offset {d9} of {d12}", "batch {d4} {d4} {d4} {d4} is empty", "The key AB{d2} {d4} {d4} {d4} is a fixture", "epoch {d10} was logged", "id={d9} seq={d12}", "checksum {d11}", "Done in {d9}", "Reverting {d9} makes it go away.", "After {d9} the loader works.", "Before {d10} it did not.", "See {d9} and {d9}.", "{d9}", "Der Stand {d9} geht.", "Le commit {d9} change tout.", "El cambio {d9} altera el orden.", "It counts {d12} rows.", "fixed by {d9}", "{w} {w} {w} {d2} {w} {w}", "It works now. {w} {w} {w}", "{w} {w} {d2} {w} {w}\nThe loader drops it.", "{w} LGTM", "Sprint {d2} Amber Finch, Silent Falcon and the rest", "Level {d1} Blue Harbor, Iron Meadow", "LGTM", "Our Footer Links Terms"]
_LABELLED_SO = ["Home", "Menu", "Search", "Startseite", "Hilfe", "Anmelden", "Accueil", "Aide", "Inicio", "Ayuda", "Packages", "People", "Activity", "Reject", "Accept", "Settings", "Branches", "Releases", "Reviewers", "Labels", "Milestone", "Vorgang", "Sprache", "Langue", "Idioma", "Members", "Forum", "Archive", "Gallery", "Tags", "Uploads", "Builds"]
_PARTS = [("Alma", "Brennholt"), ("Timo", "Castevane"), ("Renée", "O'Dorrick"), ("Karim", "Vesterlund"), ("Oda", "Marchwood-Lee"), ("Béla", "Szentkirály"), ("Nadia", "Ferrantino"), ("Jorge", "Quintavel"), ("Mei", "Tanovare"), ("Stefan", "Grünthal"), ("Lucía", "Peralvo"), ("Tove", "Ekstrandh")]


def _values(rng: random.Random) -> dict:
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    pick = rng.choice
    first, last = pick(_PARTS)[0], pick(_PARTS)[1]
    plain = re.sub(r"[^a-z]", "", last.lower()) or "user"
    local = pick([f"{first.lower()[:1]}{plain}", f"{plain}+forge", f"{plain}_{d(2)}", f"{plain}-x", f"a.{plain}"])
    host, top = pick(["mail", "uni", "inbox", "staff.meshline", "quarry-labs", "home"]), pick(["example", "test", "invalid", "org", "com"])
    mail = pick([f"{local}@{host}.{top}"] * 4 + [f"{local}[at]{host}[dot]{top}", f"{local} (at) {host}.{top}", f"{local} at {host} dot {top}", f"{local}@{host}.{top}".upper()])
    phone = pick([f"+1 ({d(3)}) 555-01{d(2)}", f"{pick(['212', '312', '415'])}-555-01{d(2)}", f"{pick(['212', '303'])}.555.01{d(2)}", f"({pick(['303', '415'])}) 555.01{d(2)}", f"+1-650-555-01{d(2)} ext. {d(2)}", f"+1415555{d(4)}", f"+44 7700 900{d(3)}", f"07700 900{d(3)}", f"+44 (0)20 7946 0{d(3)}", f"+33 1 99 00 {d(2)} {d(2)}", f"01 99 00 {d(2)} {d(2)}", f"+49 30 23125 {d(3)}", f"030/23125{d(3)}", f"+61 491 570 {d(3)}", f"{pick(['212', '312', '415'])}55501{d(2)}"])
    number = pick([f"9{d(2)}-{d(2)}-{d(4)}", f"9{d(2)} {d(2)} {d(4)}", f"{pick('789')}{d(1)}{pick(['01', '06', '11'])}{d(2)}-{d(4)}", f"{pick('KZRABCP')}{d(7)}", f"{pick(['ZR', 'KA', 'PB'])}{d(7)}", f"{d(8)}{pick('RMVZ')}"] * 3 + [f"{d(9)}", f"{d(4)} {d(4)} {d(4)} {d(4)}", f"{pick(['DE', 'FR', 'ES'])}{d(2)} {d(4)} {d(4)} {d(4)} {d(4)}"])
    city = pick(["Eastvale", "Port Merrin", "Graymouth", "Kellowby", "Santa Orla", "Niederfelden", "Lindow", "Bad Arken"])
    road = f"{pick(['Larkspur', 'Old Mill', 'Tanner', 'High', 'Quillfeather', 'Main'])} {pick(['Street', 'Lane', 'Avenue', 'Blvd', 'Court', 'Close', 'St.', 'Ave', 'Road', 'Drive'])}"
    place = pick([f"{d(2)} {pick(['Elm', 'Larkspur', 'Old Mill'])} {pick(['Grove', 'Rise', 'Mews', 'Quay'])}, {city}", f"{d(2)} {road}, {city}", f"Flat {d(1)}B, {d(3)} {road}, {city}", f"{d(2)} {road}, Apt {d(2)}, {city} {d(5)}", f"{pick(['Feldkirchweg', 'Muhrgasse', 'Alte Gerberstraße'])} {d(2)}, 0{d(4)} {city}", f"{d(2)} rue des {pick(['Lanternes', 'Grands Prés'])}, {city}", f"Calle {pick(['de la Noria', 'Larga'])} {d(2)}, {city}"])
    name = pick([f"{first} {last}"] * 6 + [f"{first} {pick('AEKLMRT')}. {last}", f"{last}, {first}"])
    return {"email": mail, "phone": phone, "id_number": number, "address": place, "name": name}


def labelled(n: int = SAMPLE, seed: int = 7) -> Iterator[tuple[str, set[tuple[int, int, str]]]]:
    """n sentences with the spans and types of their items; some names are unknown to the lexicon used in fitting."""
    rng = random.Random(seed)
    for _ in range(n):
        if rng.random() < 0.4:
            text = re.sub(r"\{w\}", lambda m: rng.choice(_LABELLED_SO), rng.choice(_UNSAID))
            yield re.sub(r"\{d(\d+)\}", lambda m: "".join(rng.choice("0123456789") for _ in range(int(m[1]))), text), set()
            continue
        kind = rng.choice(TYPES)
        values, text, spans = _values(rng), "", set()
        for i, part in enumerate(re.split(r"(\{\}|\{(?:name|address|phone)\})", rng.choice(_SAID[kind]))):
            if i % 2:
                k = kind if part == "{}" else part[1:-1]
                spans.add((len(text), len(text) + len(values[k]), k))
                part = values[k]
            text += part
        yield text, spans


@lru_cache(maxsize=2)
def fit(n: int = SAMPLE, rounds: int = ROUNDS, seed: int = 7) -> dict[str, float]:
    """Weights that maximise the conditional log likelihood of the labelled sample (adaptive gradient steps, a small penalty on their size); on the driver, in a few seconds."""
    known = [p for i, p in enumerate(_PARTS) if i % 6]
    lexicon = Lexicon({f.lower(): 9 for f, _ in known}, {x.lower(): 9 for _, x in known})
    sample = []
    for text, spans in labelled(n, seed):
        found = candidates(text, "author" if "\n" not in text and len(text) < 24 else "content", lexicon)
        if found:
            sample.append((found, [(s, e, k) in spans for s, e, k, _ in found]))
    weights: dict[str, float] = defaultdict(float)
    seen: dict[str, float] = defaultdict(float)
    rng = random.Random(seed)
    for _ in range(rounds):
        rng.shuffle(sample)
        for found, right in sample:
            _, chance, moves = marginals(found, weights)
            slope: dict[str, float] = defaultdict(float)
            last = "^"
            taken: set[tuple[int, int, str]] = set()
            for (s, e, k, f), good, p in sorted(zip(found, right, chance), key=lambda x: x[0][:2]):
                first = good and (s, e, k) not in taken  # two patterns may propose one span: they share its weight
                if first:
                    taken.add((s, e, k))
                    slope[f"{last}>{k}"] += 1.0
                    last = k
                share = sum(1 for c in found if c[:3] == (s, e, k)) if good else 1
                change = (1.0 / share if good else 0.0) - p
                if abs(change) > 1e-3:
                    for x in f:
                        slope[x] += change
            for x, p in moves.items():
                slope[x] -= p
            for x, g in slope.items():
                g -= PENALTY * weights[x]
                seen[x] += g * g
                if g:
                    weights[x] += STEP * g / (1e-6 + math.sqrt(seen[x]))
    return {x: w for x, w in weights.items() if abs(w) > 1e-9}


def name_parts(authors: DataFrame, author: str, max_parts: int = MAX_PARTS) -> Lexicon:
    """First and last parts of the names in the author fields of all rows.

    Counted over everything; those seen twice or more come to the driver, all
    of them: more than max_parts are an error.
    """
    word = rf"([{_U}][\p{{L}}]*(?:['’-][\p{{L}}]+)*)"
    a = F.col(author)
    plain, turned = rf"(?:^|\(){word} (?:[A-Z]\. )?{word}(?:$| <|\))", rf"^{word}, {word}$"
    pair = lambda f, s: F.struct(f.alias("first"), s.alias("last"))
    both = F.when(a.rlike(plain), pair(F.regexp_extract(a, plain, 1), F.regexp_extract(a, plain, 2))).when(a.rlike(turned), pair(F.regexp_extract(a, turned, 2), F.regexp_extract(a, turned, 1)))
    parts = authors.where(a.rlike(rf"[{_U}]")).select(F.explode(F.array(both)).alias("p")).select(F.explode(F.array(F.struct(F.lit(True).alias("is_first"), F.lower("p.first").alias("part")), F.struct(F.lit(False).alias("is_first"), F.lower("p.last").alias("part")))).alias("x")).select("x.*").where("part is not null")
    rows = parts.groupBy("is_first", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(max_parts + 1).collect()
    if len(rows) > max_parts:
        raise LayoutError(f"more than {max_parts} parts of names")
    return Lexicon({r.part: r.n for r in rows if r.is_first}, {r.part: r.n for r in rows if not r.is_first})


def found_in(text: str | None, field: str, lexicon: Lexicon, weights: dict[str, float]) -> list[tuple[int, int, str]]:
    """start, end, type of the items of one text; none in null and empty texts."""
    if not text:
        return []
    found = candidates(text, field, lexicon)
    return [(s, e, k) for s, e, k, _ in best_segments(found, weights)] if found else []


def masked(text: str | None, items: Iterable[tuple[int, int, str]]) -> str | None:
    """The text with each item replaced by <TYPE>, the rest unchanged; null stays null."""
    if text is None:
        return None
    out, at = [], 0
    for s, e, k in items:
        out += [text[at:s], f"<{k.upper()}>"]
        at = e
    return "".join([*out, text[at:]])


def items_of(column: Column, field: Column, lexicon: Lexicon, weights: dict[str, float] | None = None) -> Column:
    """array<struct<start,end,type>>: the items of each text, by position in code points."""
    weights = fit() if weights is None else weights

    @F.pandas_udf("array<struct<start:int,end:int,type:string>>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, fields in batches:
            yield pd.Series([[{"start": s, "end": e, "type": k} for s, e, k in found_in(t, f, lexicon, weights)] for t, f in zip(texts, fields)])

    return run(column, field)


def types_of(column: Column, field: Column, lexicon: Lexicon, weights: dict[str, float] | None = None) -> Column:
    """array<string>: the distinct types of items in each text."""
    weights = fit() if weights is None else weights

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, fields in batches:
            yield pd.Series([sorted({k for _, _, k in found_in(t, f, lexicon, weights)}) for t, f in zip(texts, fields)])

    return run(column, field)


def masked_text(column: Column, field: Column, lexicon: Lexicon, weights: dict[str, float] | None = None) -> Column:
    """string: each text with typed placeholders for its items."""
    weights = fit() if weights is None else weights

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, fields in batches:
            yield pd.Series([masked(t, found_in(t, f, lexicon, weights)) for t, f in zip(texts, fields)], dtype=object)

    return run(column, field)
