"""Template residue, filler, error pages and script notices instead of content.

Texts are cut into units (lines, sentences, parts between bars and dots), units
are masked (numbers, addresses, dates, ids, placeholders), and exact hashes of the
masked units are counted over all texts and sources. Each widely recurring unit
is classified once, by phrase and placeholder rules; a recurring unit that no
rule knows belongs to a message if nearly all texts that hold it hold a known
unit of one, too: so names of sites, buttons and closing remarks of error pages
are learned, not listed. A text is residue if one of its units holds a
placeholder, or if all of its units belong to messages, forms or filler. The
words of filler are learned, as well: those that stand, nearly always, in texts
with a word of the usual imitation Latin. What recurs nowhere is held against
the same rules, but has to fit them as a whole. Code and quoted text are no
residue: a text that discusses such things is content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators.lookup import sized
from forgelake.session import written

#: A masked unit recurs widely from so many texts on, in so many sources (at least 2).
WIDE_TEXTS, WIDE_SOURCES = 5, 2

#: Share of a unit's texts that must hold a known unit of a message for it to be part of one; share of a word's texts with imitation Latin for it to be filler; share of a text's words that must be.
PART_SHARE, FILLER_SHARE, FILLER_WORDS = 0.8, 0.5, 0.8

# Names of what a template asks for, where brackets alone would not tell.
_ASKED = "user|name|username|summary|title|project|reviewer|version|component|date|description|ticket|id|author|owner|company|product|email|url|branch|repo|repository|environment|team|customer|number|value|placeholder|topic|service"
_NAME = r"[A-Za-z][A-Za-z0-9]*(?:[_. -][A-Za-z0-9]+)*"
_ASKING = rf"(?:[A-Za-z][A-Za-z0-9]*(?:[_.][A-Za-z0-9]+)+|(?:{_ASKED})|(?:short|long|your|the|first|last|full|issue|release|user|ticket|project|company) (?:{_ASKED}))"

#: A placeholder where a value belongs, in any of the usual notations.
PLACEHOLDER = "|".join([
    rf"[$#]\{{\s*{_NAME}\s*\}}", rf"\{{\{{\s*{_NAME}\s*\}}\}}", rf"<<\s*{_NAME}\s*>>", rf"<%=?\s*{_NAME}\s*%>", rf"%%\s*{_NAME}\s*%%", r"(?<![\w%])%[A-Z][A-Z_]{2,}%(?![\w%])", rf"@@\s*{_NAME}\s*@@", rf"\[\[\s*{_NAME}\s*\]\]",
    rf"(?<![\w$#{{])\{{\s*(?i:{_ASKING})\s*\}}(?!\}})", rf"(?<![\w\[\]!])\[\s*(?i:{_ASKING})\s*\](?![\](:\[])", rf"(?<![\w<])<\s*(?i:{_ASKING})\s*>(?!>)", rf"(?<!\w)__(?i:{_ASKING})__(?!\w)",
])

#: Lines of a form that nobody filled in (whole lines; the key before a colon may stay).
_STUB = r"(?:tb[ad]|to be (?:written|filled in|done|added|announced|decided|defined)|n/?a(?: - please replace)?|none yet|please replace|\((?:optional|describe|how was|what|why|your|add|explain)[^)\n]*\)|\((?:à compléter|à remplir|bitte ergänzen|bitte ausfüllen|por completar|a completar)[^)\n]*\)|\[(?:fill in|bitte|à compléter|à remplir|por completar|your|describe|add|optional)[^\]\n]*\]|_?no response_?|your (?:text|answer|name|description) here|type your answer[^\n]*|x\.y\.z|[yjaа]{4}-mm-[dtj]{2}|dd[./-]mm[./-]yyyy|name of the (?:person|author|owner|reviewer)|\.\.\.|…|insert [\w ]+ here|describe (?:here|your change here)|delete this (?:section|line)[^\n]*|replace this (?:text|line|section)[^\n]*|your [\w ]{1,40} (?:goes|go) here)"
STUB_LINE = rf"(?i)^\s*(?:[-*+]\s*)?(?:[^:\n]{{1,40}}:\s*)?{_STUB}\s*[.]?\s*$|^\s*(?:[-*+]\s+)?\[ \][^\n]*$|^\s*(?:\d+[.)]|[-*+])\s*$|(?i)^\s*(?:(?:closes|fixes|resolves|refs)\s+#|cc\s+@|/(?:kind|assign|label|area|priority))\s*$|^\s*§form§\s*$"
HEADING_LINE = r"^\s*#{1,6}\s+\S[^\n]*$|^\s*\*{1,2}[^*\n]{1,60}\*{1,2}:?\s*$|^\s*[^.!?:\n]{1,50}:\s*$|^\s*-{3,}\s*$|^\s*={3,}\s*$|^\s*\|?[\s|:-]+\|?\s*$"

# Reasons of error pages, in the languages of the corpus.
_REASON = r"(?:not found|nicht gefunden|introuvable|no encontrad[ao]|bad request|unauthori[sz]ed|forbidden|method not allowed|request time-?out|gone|conflict|too many requests|internal server error|error interno del servidor|interner serverfehler|erreur interne(?: du serveur)?|bad gateway|service unavailable|gateway time-?out|i'm a teapot|unprocessable (?:entity|content))"
ERROR_UNIT = r"(?:" + "|".join([
    rf"(?:http[ /]?(?:1\.[01]|2)? ?|error |erreur |fehler |status |code )*[45]\d\d(?:\s*[-:–—.]?\s*\(?{_REASON}\)?)?(?:\s*[-–—:|]\s*{_REASON})?[.!]?(?: while [^\n.]{{1,80}}\.?)?",
    r"error \d{3} - [^\n.]{3,80}\.?", r"erreur \d{3} ?: [^\n.]{3,80}\.?", r"fehler \d{3} ?[:-] [^\n.]{3,80}\.?", rf"{_REASON}(?:[.!]|: [^\n.]{{3,60}}\.?)?",
    r"the page you are looking for [^\n.]{3,60}\.", r"(?:this|the) (?:repository|page|project|thread|file|site) (?:has been|was|is|could not be|cannot be) [^\n.]{0,20}(?:disabled|removed|deleted|moved|blocked|shown|found|unavailable|private|loaded)[^\n.]{0,40}\.", r"die angeforderte seite [^\n.]{3,60}\.", r"cette page n'existe [^\n.]{0,30}\.", r"la página [^\n.]{0,40}no existe[^\n.]{0,20}\.",
    r"no se pudo cargar [^\n.]{3,40}\.", r"oops[!,.]?", r"whoops[^\n.]{0,60}[.!]", r"(?:oops[!,] )?something (?:broke|went wrong)[^\n.]{0,40}[.!]", r"your session has expired[^\n.]{0,60}\.", r"unexpected token [^\n]{1,5} at position \d+[^\n.]{0,60}\.?", r"access denied[.!]?", r"you do not have permission [^\n.]{3,60}\.", r"(?:checking|verifying) your browser [^\n.]{0,80}(?:\.{3}|[.…])?", r"gateway timeout while [^\n.]{3,60}\.", r"the server is down [^\n.]{3,80}\.", r"you have exceeded the limit [^\n.]{0,80}\.", r"(?:verify|prove|confirm) (?:that )?you are (?:a )?human[^\n.]{0,40}\.?", r"the server (?:encountered|returned) an? [^\n.]{0,40}error[^\n.]{0,40}\.", r"proxy error[.!]?", r"(?:this )?request (?:was |has been )?(?:blocked|timed out)[^\n.]{0,40}\.?", r"upstream (?:connect error|request timeout)[^\n]{0,60}", r"loading thread(?:\.{3}|…)?", r"der server [^\n.]{0,60}(?:fehler|nicht erreichbar)[^\n.]{0,30}\.",
]) + ")"
SCRIPT_UNIT = r"(?:" + "|".join([
    r"(?:you need|you must have) (?:scripts|javascript)[^\n.]{0,60}\.", r"(?:this|the|our)? ?[\w -]{0,40}(?:requires?|needs) (?:javascript|scripts|client-side scripts)[^\n.]{0,60}\.", r"[\w -]{1,40} relies on (?:javascript|scripts|client-side scripts)[^\n.]{0,60}\.", r"your browser blocks (?:scripts|javascript)[^\n.]{0,60}\.", r"(?:(?:this|the) )?[\w -]{1,40}(?:does not|will not|cannot|can't|won't) (?:work|run|load|be shown) without (?:javascript|scripts|client-side scripts)[^\n.]{0,60}\.", r"javascript (?:is|must be|has been|seems to be|appears to be) (?:disabled|enabled|turned off|off|required)[^\n.]{0,60}\.", r"some parts of [\w -]{1,40} will not load\.", r"(?:please )?(?:enable|allow|activate|turn on) (?:javascript|scripts|scripting)[^\n.]{0,60}\.?", r"noscript: [^\n]{3,60}", r"loading(?:\.{3}|…)? if nothing happens[^\n.]{0,60}\.", r"if nothing happens[^\n.]{0,60}\.", r"loading(?:\.{3}|…)", r"bitte aktivieren sie javascript[^\n.]{0,60}\.", r"veuillez activer javascript[^\n.]{0,60}\.", r"es necesario habilitar javascript[^\n.]{0,60}\.", r"(?:por favor,? )?(?:active|habilite) javascript[^\n.]{0,60}\.", r"javascript (?:est|ist|está) [^\n.]{3,60}\.", r"your browser (?:has|does not)[^\n.]{0,30}(?:javascript|scripts)[^\n.]{0,60}\.",
]) + ")"
TAIL_UNIT = r"(?:" + "|".join([
    r"go back", r"back to home", r"status page", r"retry", r"home", r"(?:please )?(?:try|check) [^\n.]{0,40}(?:again|later|retry)[^\n.]{0,30}\.?", r"contact support[^\n.]{0,40}\.", r"if you think this is a mistake[^\n.]{0,60}\.", r"(?:request|incident|error|trace|reference)(?: id| code| number)?:? #?[0-9a-f]{4,40}\.?", r"ray(?: id)?:? [0-9a-f]{6,20}", r"node [\w.-]+(?:, trace [0-9a-f]+)?", r"(?:proxy|nginx|apache|server|gateway|edge)/[\d.]+", r"réessayez [^\n.]{0,40}\.", r"vuelva a intentarlo[^\n.]{0,40}\.", r"(?:bitte )?versuchen sie es [^\n.]{0,40}\.", r"this may take \d+ \w+\.", r"the address may be wrong\.", r"bitte (?:spater|später) erneut versuchen\.", r"(?:our|the) team has been (?:told|notified|informed)[^\n.]{0,30}\.", r"the (?:thread|page|file|project|repository) may have been [^\n.]{3,60}\.", r"please (?:reload|refresh) [^\n.]{0,40}\.",
]) + ")"

_ANY = f"(?:{ERROR_UNIT}|{SCRIPT_UNIT}|{TAIL_UNIT})"
MESSAGE_UNIT = rf"(?iu)^{_ANY}(?:\s+{_ANY})*$"
CORE_UNIT = rf"(?iu)^(?:{ERROR_UNIT}|{SCRIPT_UNIT})"

#: Cues that make a widely recurring unit of a few words a message though no rule knows it whole.
LOOSE = "|".join([
    r"(?iu)^(?![^#`]{0,200}\b(?:reports?|gets?|shows?|throws?|sees?|hides?|logs?|returns?|retries|raises?|we|i)\b)(?:please (?:enable|wait|log in|sign in)|you (?:need|must)|this (?:page|site|app|thread|repository|video|image|content|file|item|product|feature) |(?:loading|redirecting|checking|error|oops|sorry)[ ,.:!…]|your (?:session|browser|request) |the (?:page|server|request|requested|site|url) )[^#`]{0,200}(?:javascript|scripts?|browser|server|error|expired|denied|not found|(?:un|not |no longer )available|maintenance|disabled|again|redirected)\b[^#`]{0,120}$",
    r"(?iu)^(?:just a moment|one moment(?:,? please)?|please wait|please stand by|hang on|loading|redirecting|coming soon|under construction|(?:page|file|content|video|image) (?:not found|unavailable|not available)|(?:click|tap) (?:here|to) (?:to )?(?:edit|add|change|replace|enter) [^#`\n]{1,60}|(?:add|edit|enter|insert|write|type|replace) (?:your|this|the|some) (?:own )?(?:text|title|content|heading|description|name|tagline|message)[^#`\n]{0,40}|that[’']s an error|an error (?:has )?occurred[^#`\n]{0,60}|we are sorry[^#`\n]{0,80}|we[’']re sorry[^#`\n]{0,80}|cookies (?:must be|are) (?:enabled|disabled|required)[^#`\n]{0,60}|untitled(?: document| page)?|(?:this is (?:a |an )?)?(?:sample|example|default|placeholder) (?:page|post|text|title|content))\s*(?:\.{1,3}|…|!)?$",
])

# Words of imitation Latin.
LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
SEEDS = ("lorem", "ipsum", "consectetur", "adipiscing", "eiusmod", "incididunt", "aliqua", "ullamco", "aliquip", "excepteur", "cupidatat")
FILLER_TEXT = r"(?iu)^(?:(?:this is (?:a )?(?:dummy|filler|sample|placeholder|example) text|sample paragraph[^.\n]{0,40}|(?:dummy|filler|placeholder) text(?: here)?|text text text[^.\n]{0,30}|lorem ipsum[^\n]*)[.!]?\s*)+$"


_FROM, _TO = "áàâäãåéèêëíìîïóòôöõúùûüñçýÁÀÂÄÉÈÊËÍÓÒÔÖÚÙÛÜÑÇ\u00a0\u200b\ufeff", "aaaaaaeeeeiiiiooooouuuuncyAAAAEEEEIOOOOUUUUNC "


def plain(text: Column) -> Column:
    """Letters without accents, no-break spaces as spaces: what the rules read."""
    return F.translate(text, _FROM, _TO)


def _bare(pattern: str) -> str:
    return pattern.translate(str.maketrans(_FROM[:len(_TO)], _TO, _FROM[len(_TO):]))


def masked(text: Column) -> Column:
    """The text in lower case with numbers, ids, addresses and dates replaced and white space collapsed."""
    m = F.lower(text)
    for pattern, to in (
        (r"(?:https?://|www\.)\S+", "~url"), (r"[\w.+-]+@[\w-]+\.[\w.-]+", "~mail"), (r"\b\d{4}-\d\d-\d\d(?:[t ]\d\d:\d\d(?::\d\d)?z?)?\b|\b\d\d?[./]\d\d?[./]\d{4}\b", "~date"),
        (r"(?<=\s)/[\w./-]+", "~path"), (r"\b(?=[a-f]*\d)[0-9a-f]{6,40}\b", "~id"), (r"\d+(?:[.,:]\d+)*", "0"), (r"[\s\u00a0\u200b\ufeff]+", " "),
    ):
        m = F.regexp_replace(m, pattern, to)
    return F.trim(m)


#: Where a text is cut into units.
CUTS = r"[\r\n]+|(?<=[.!?…])\s+(?=[\p{Lu}\d–—~§(\[])|\s+[–—|·]\s+|^[–—|·]\s+"


def _one(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"\s+", " "), r"^[–—|·] ", ""))


def _trimmed(text: Column) -> Column:
    """What the rules read; null for blank texts."""
    t = F.btrim(plain(text), F.lit(" \t\n\r\f\v"))
    return F.when(t != "", t)


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda x: F.length(x) > 1)


def _of_texts(docs: DataFrame, text: str) -> DataFrame:
    """docs with __t (trimmed), __h (its hash, null for blank), __bare (without code, quotes and what placeholders hold), __units (h: hash of the masked unit, u) and the different __hashes; __row tells rows apart within one pass."""
    out = docs.withColumn("__t", _trimmed(F.col(text))).withColumn("__h", F.when(F.col("__t").isNotNull(), F.xxhash64("__t")))
    may_hold = F.col("__t").rlike(r"[{<\[]|%|@@|__|`|\"")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("__t", r"```[\s\S]*?(?:```|$)", " § "), r"`[^`\n]*`", " § "), r"\"[^\"\n]*\"", " § ")
    bare = F.when(F.col("__t").isNull() | ~may_hold, F.col("__t")).otherwise(F.regexp_replace(F.regexp_replace(bare, r"<!--[\s\S]*?-->", "\n§form§\n"), PLACEHOLDER, " ~v "))
    bare = F.when(F.col("__t").contains("\n-"), F.regexp_replace(bare, r"(?m)^[^\n]{1,60}\r?\n-{3,}\s*$", "---")).otherwise(bare)
    out = out.withColumn("__bare", bare)
    units = F.filter(F.transform(F.split("__bare", CUTS), _one), lambda x: x != "")
    out = out.withColumn("__units", F.transform(units, lambda x: F.struct(F.xxhash64(F.when(x.rlike(r"[0-9@/]|www\."), masked(x)).otherwise(F.lower(x))).alias("h"), x.alias("u"))))  # only those have anything to mask
    return out.withColumn("__row", F.monotonically_increasing_id()).withColumn("__hashes", F.array_distinct(F.transform("__units", lambda x: x["h"])))


def _unit_kind(u: Column) -> Column:
    """What a recurring unit is, by the rules: placeholder, form, filler, script_notice, error_page, neutral (headings, numbers, closing remarks) or null."""
    known = lambda p: u.rlike(_bare(p))
    return (
        F.when(u.contains("~v"), "placeholder").when(known(rf"(?iu)^{_ANY}(?:\s+{_ANY})*$") & known(rf"(?iu)^{SCRIPT_UNIT}"), "script_notice").when(known(MESSAGE_UNIT) & known(CORE_UNIT), "error_page")
        .when(known(LOOSE), "recurring").when(known(STUB_LINE), "form").when(u.rlike(FILLER_TEXT), "filler").when(known(MESSAGE_UNIT) | u.rlike(HEADING_LINE) | u.rlike(r"^[\d\s.,:~§|/-]+$"), "neutral")
    )


def message_units(texts: DataFrame, source: str) -> DataFrame:
    """__u (hash), unit, kind, n, n_known: the widely recurring units that rules know, and those that stand with known ones.

    texts: of _of_texts. Counted over all texts; hash, count and least and
    greatest source are shuffled, combined before, then the units themselves, once
    per task, for the recurring ones only.
    """
    cores = ("script_notice", "error_page", "recurring", "filler")  # what stands beside a form is a text that someone began
    each = texts.where("__h is not null").select(F.col(source).alias("s"), F.explode("__hashes").alias("__u"))
    wide = sized(written(each.groupBy("__u").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("a"), F.max("s").alias("b")).where((F.col("n") >= WIDE_TEXTS) & (F.col("a") != F.col("b"))).select("__u", "n"), "wide-units"))
    named = texts.where("__h is not null").select(F.explode("__units").alias("x")).select(F.col("x.h").alias("__u"), F.col("x.u").alias("unit"))
    kinds = written(named.join(wide, "__u").groupBy("__u").agg(F.min("unit").alias("unit"), F.first("n").alias("n")).withColumn("kind", _unit_kind(F.col("unit"))), "unit-kinds")
    core = sized(kinds.where(F.col("kind").isin(*cores)).select(F.col("__u").alias("__c"), F.lit(True).alias("__core")))
    # Texts with a known unit, by hash: what else stands in them.
    with_core = texts.where("__h is not null").select("__hashes", "__row", F.explode("__hashes").alias("__c")).join(core, "__c").groupBy("__row").agg(F.first("__hashes").alias("__hashes"))
    beside = with_core.select(F.explode("__hashes").alias("__u")).groupBy("__u").agg(F.count(F.lit(1)).alias("n_known"))
    out = kinds.join(beside, "__u", "left").withColumn("n_known", F.coalesce("n_known", F.lit(0)))
    part = F.when(F.col("kind").isNull() & (F.col("n_known") >= PART_SHARE * F.col("n")), "part").otherwise(F.col("kind"))
    return out.withColumn("kind", part).where("kind is not null")


def filler_words(texts: DataFrame) -> DataFrame:
    """word: those that stand in WIDE_TEXTS texts, in most of them beside a word of the usual imitation Latin.

    Words are counted once a text, over all texts; only the words of texts with
    imitation Latin are counted at all.
    """
    words = F.array_distinct("__w")
    latin = F.arrays_overlap("__words", F.array(*[F.lit(w) for w in SEEDS]))
    each = texts.where("__h is not null").select(words.alias("__words")).withColumn("latin", latin)
    near = sized(written(each.where("latin").select(F.explode("__words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= WIDE_TEXTS), "latin"))
    all_ = each.select(F.explode("__words").alias("word")).join(near.select("word"), "word").groupBy("word").agg(F.count(F.lit(1)).alias("m"))
    return near.join(all_, "word").where(F.col("n") >= FILLER_SHARE * F.col("m")).select("word")


def classified(docs: DataFrame, text: str, source: str) -> DataFrame:
    """docs with residue and residue_by; residue: `placeholder`, `form`, `filler`, `error_page`, `script_notice`, `recurring` (a message that only its recurrence shows), or null for content.

    residue_by: `group` where the recurring units decide, `rule` where a rare text fits the
    rules as a whole. Null, empty and blank texts are null (they hold no
    residue). Repeated rows keep their place; columns called residue and
    residue_by are replaced. Whole texts are looked at whatever their length.
    Texts are judged by their hash, so no text is shuffled but the units that recur.
    """
    docs = docs.drop("residue", "residue_by")
    # Cut, masked and hashed once; one row per different text and source.
    cut = _of_texts(docs.select(F.col(text).alias("__text"), F.col(source).alias("__source")), "__text").where("__h is not null")
    base = written(cut.select("__row", "__h", "__source", "__units", "__hashes", _words("__t").alias("__w"), _by_rule().alias("__rule")), "cut")
    units = written(message_units(base, "__source").select("__u", "kind"), "units")
    latin = written(filler_words(base), "filler")
    hits = base.where("__h is not null").select("__h", F.size("__hashes").alias("size"), "__row", F.explode("__hashes").alias("__u")).join(sized(units), "__u")
    has = lambda *k: F.max(F.col("kind").isin(*k).cast("int"))
    seen = hits.groupBy("__row").agg(F.first("__h").alias("__h"), (F.count(F.lit(1)) == F.first("size")).alias("whole"), *[has(k).alias(k) for k in ("placeholder", "form", "filler", "error_page", "script_notice", "recurring")])
    group = F.when(F.col("placeholder") == 1, "placeholder").when(F.col("whole"), F.when(F.col("form") == 1, "form").when(F.col("filler") == 1, "filler").when(F.col("script_notice") == 1, "script_notice").when(F.col("error_page") == 1, "error_page").when(F.col("recurring") == 1, "recurring"))
    strange = base.select("__h", "__w", "__row").where(F.size("__w") >= 5)
    matched = strange.select("__h", F.size("__w").alias("size"), "__row", F.explode("__w").alias("word")).join(sized(latin), "word").groupBy("__row").agg(F.first("__h").alias("__h"), (F.count(F.lit(1)) >= FILLER_WORDS * F.first("size")).alias("most")).where("most").select("__h", F.lit("filler").alias("__group"))
    decided = seen.select("__h", group.alias("__group")).where("__group is not null").unionByName(matched).groupBy("__h").agg(F.max("__group").alias("__group"))
    ruled = base.where("__rule is not null").groupBy("__h").agg(F.max("__rule").alias("__rule"))
    found = written(decided.join(ruled, "__h", "full"), "residue")
    by = F.when(F.col("__group").isNotNull(), "group").when(F.col("__rule").isNotNull(), "rule")
    t = _trimmed(F.col(text))
    keyed = docs.withColumn("__k", F.when(t.isNotNull(), F.xxhash64(t)))
    out = keyed.join(sized(found), F.col("__k") == F.col("__h"), "left")
    return out.withColumns({"residue": F.coalesce("__group", "__rule"), "residue_by": by}).drop("__k", "__h", "__group", "__rule")


def _by_rule() -> Column:
    """What a text (__t, __bare) is that fits the rules as a whole, unit by unit, however rare; costly looks are behind cheap ones that no text of their class can fail."""
    t = F.col("__t")
    first = F.substring_index("__t", "\n", 1)
    may_be_form = t.contains("\n-") | t.contains("<!--") | first.rlike(HEADING_LINE) | first.rlike(_bare(STUB_LINE))
    lines = F.filter(F.split("__bare", r"\r?\n|\r"), lambda x: ~x.rlike(r"^\s*$"))
    stub = lambda x: x.rlike(_bare(STUB_LINE))
    form = may_be_form & F.forall(lines, lambda x: stub(x) | x.rlike(HEADING_LINE)) & F.exists(lines, stub)
    units = F.filter(F.transform(F.split("__t", CUTS), _one), lambda x: x != "")
    # The name of the site may stand beside a message: one or two words that end in no stop.
    name = lambda x: x.rlike(r"^[\p{Lu}][\p{L}\d]*(?: [\p{Lu}][\p{L}\d]*)?$")
    core = lambda x: x.rlike(_bare(CORE_UNIT))
    fits = lambda x: x.rlike(_bare(MESSAGE_UNIT)) | F.regexp_replace(x, r"^\p{Lu}[\p{L}\d]* (?=\p{Lu})", "").rlike(_bare(MESSAGE_UNIT))
    message = F.exists(units, core) & F.forall(units, lambda x: fits(x) | name(x)) & (F.size(F.filter(units, lambda x: name(x) & ~fits(x))) <= 1)
    script = F.exists(units, lambda x: x.rlike(_bare(rf"(?iu)^{SCRIPT_UNIT}")))
    may_be_message = F.get(units, F.lit(0)).rlike(_bare(rf"(?iu)^{_ANY}")) | name(F.get(units, F.lit(0)))
    words = F.filter(F.split(F.lower("__t"), r"[^\p{L}]+"), lambda x: x != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    latin = F.array(*[F.lit(w) for w in LATIN])
    filler = t.rlike(FILLER_TEXT) | ((n >= 6) & (distinct <= 6) & (n >= 2 * distinct)) | ((n >= 5) & F.arrays_overlap(words, F.array(*[F.lit(w) for w in SEEDS])) & (F.size(F.filter(words, lambda w: F.array_contains(latin, w))) >= FILLER_WORDS * n))
    held = F.col("__bare").contains(" ~v ")
    return F.when(held, "placeholder").when(form, "form").when(filler, "filler").when(may_be_message & message, F.when(script, "script_notice").otherwise("error_page"))


def messages(docs: DataFrame, text: str, source: str) -> DataFrame:
    """One row per masked residue text: an example, its class, and how many texts of how many sources it stands in."""
    found = classified(docs, text, source).where("residue is not null")
    grouped = found.withColumn("__m", masked(F.col(text))).groupBy("__m", "residue", source).agg(F.count(F.lit(1)).alias("n"))
    return grouped.groupBy("__m", "residue").agg(F.sum("n").alias("n_texts"), F.count(source).alias("n_sources")).withColumnRenamed("__m", "message")
