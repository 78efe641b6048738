import pytest

from forgelake.llm import residue

CASES = [
    ("Title: TBD\nOwner: TBD\nBackground: to be filled in\n\nCloses #", "form"), ("### Owner\n[fill in]\n\n### Risks\n1.\n2.\n3.\n\n/kind", "form"), ("<!-- Please explain -->\n\n### Screenshots\n\n- [ ] I read the rules", "form"), ("Release note\n---\nx.y.z\n\nExpected result\n---\nType your answer below this line", "form"),
    ("**Motivation**\n\n(optional)\n\n**Resumen**\n\nYour text here", "form"), ("INSERT DESCRIPTION HERE\n\nINSERT STEPS HERE\n\nCloses #", "form"), ("Text text text, more text here. Text text text, more text here.", "filler"), ("test test test test test test", "filler"),
    ("Lorem ipsum dolor sit amet, sed do eiusmod tempor. Ut labore et dolore.", "filler"), ("404 Not Found\nNo se pudo cargar la página. – Codeharbor", "error_page"), ("Oops! Something broke on our side. Incident 30b9d63.", "error_page"), ("HTTP 503\nService Unavailable Try again later.", "error_page"),
    ("Fehler 429 (Too Many Requests) Bitte später erneut versuchen.", "error_page"), ("ERROR 403: FORBIDDEN. BITTE SPÄTER ERNEUT VERSUCHEN.\nBACK TO HOME", "error_page"), ("503 | Service Unavailable | Codeharbor\n\nRéessayez dans quelques minutes.", "error_page"), ("This page requires JavaScript.", "script_notice"),
    ("Loading… If nothing happens, allow scripts for this site.", "script_notice"), ("Codeharbor\nVeuillez activer JavaScript pour afficher cette page.", "script_notice"), ("Thís pagé requires JavaScript.​", "script_notice"), ("Dear {SUMMARY}, your change was merged on <%= user_name %>.\n\nA real text follows.", "placeholder"),
    ("Steps to reproduce on ${user_name} are listed below.", "placeholder"), ("This release of [short description] contains the following changes.", "placeholder"), ("Installed __ticket_id__ well.", "placeholder"), ("Assigned to <reviewer> for review.", "placeholder"),
    ("Our template engine expands `{{ user_name }}` too early.", None), ("The fixture uses `${HOME_DIR}` and `%s` on purpose.", None), ("```\n${user_name}\n```", None), ("A 502 from the proxy is retried 8 times before the page walker gives up.", None), ("Users without JavaScript get a blank page, we could show a short notice there.", None),
    ("I filled in the checklist, all boxes are ticked.", None), ('The rate limit error hides it, which is why "too many requests" shows up.', None), ("- [ ] tests\n\nThe parser drops the batch.", None), ("[2.8.0] retry queue ignores counter", None), ("label-otter[bot] said a[0] and {x}", None), ("[docs] explain it", None),
    ("", None), (None, None), (" \n​", None), ("word " * 40_000 + "end.", "filler"), ("Fine words about the parser. " + "abc def ghi jkl mno pqr stu vwx. " * 5000, None),
]


def test_classes(spark):
    df = spark.createDataFrame([(i, t, "a") for i, (t, _) in enumerate(CASES)], "id int, text string, residue string")
    got = {r.id: r.residue for r in residue.classified(df.withColumnRenamed("residue", "source"), "text", "source").collect()}
    assert {CASES[i][0][:60] if CASES[i][0] else CASES[i][0]: k for i, k in got.items()} == {t[:60] if t else t: k for t, k in CASES}
    assert residue.classified(df.limit(0).withColumnRenamed("residue", "source"), "text", "source").count() == 0


@pytest.mark.parametrize("n, sources, want", [(5, 2, True), (4, 2, False), (6, 1, False)])
def test_recurring_messages(spark, n, sources, want):
    """A notice no rule knows whole is residue where it recurs widely, in several sources."""
    rows = [(i, f"Your session {i} was closed by the server", f"s{i % sources}") for i in range(n)] + [(99, "Your parser was closed", "s0")]
    df = spark.createDataFrame(rows, "id int, text string, source string")
    assert {r.id for r in residue.classified(df, "text", "source").where("residue = 'recurring'").collect()} == (set(range(n)) if want else set())


def test_messages(spark):
    df = spark.createDataFrame([(1, "Error 404: Not Found", "a"), (2, "error  500: internal server error", "b"), (3, "Error 404: Not Found", "b"), (4, "fine", "a"), (5, "Error 404: Not Found", None)], "id int, text string, source string")
    got = {r.message: (r.n_texts, r.n_sources) for r in residue.messages(df, "text", "source").collect()}
    assert got == {"error 0: not found": (3, 2), "error 0: internal server error": (1, 1)}


def test_a_recurring_message_needs_one_known_unit(spark):
    """All texts are counted, not only those with a loose cue; rare ones still need every unit to be known."""
    from forgelake.llm.residue import classified

    rows = [(i, f"Gateway timeout while reading the list. Node pool {i} was drained by hand.", "ab"[i % 2]) for i in range(6)] + [(9, "Gateway timeout while reading the list. We saw it twice.", "a")]
    rows += [(20 + i, f"Bump the parser to {i}.", "ab"[i % 2]) for i in range(6)]
    got = {r.id: r.residue for r in classified(spark.createDataFrame(rows, "id int, text string, source string"), "text", "source").collect()}
    assert got == {**{i: "error_page" for i in range(6)}, 9: None, **{20 + i: None for i in range(6)}}


FRESH = [
    "Just a moment...", "This video is unavailable", "Dear %FIRSTNAME%, welcome.", "Hello [First Name], your order has shipped.", "Click here to edit this text.", "Lorem ipsum dolor sit amet. Aenean commodo ligula eget dolor, aenean massa.",
    "404. That's an error. The requested URL /a/b was not found on this server. That's all we know.", "Access denied | Sparrowhub", "Please stand by…",
]


def test_fresh_messages_are_caught_where_they_recur(spark):
    """Texts in no rule's own words, repeated over sources; what is said about such things recurs, too, and stays."""
    sound = ["Thanks, merging.", "docs: explain the socket", "Users of the old browser get an error here, so we retry.", "The page walker reports an error twice. See the log.", "[docs] explain it", "- [ ] tests\nThe parser drops it.", "This change is fine for now."]
    rows = [(100 * i + k, t, "abc"[k % 3]) for i, t in enumerate(FRESH + sound) for k in range(9)]
    got = {r.id: r.residue for r in residue.classified(spark.createDataFrame(rows, "id int, text string, source string"), "text", "source").collect()}
    assert {i: got[100 * i] for i in range(len(FRESH)) if not got[100 * i]} == {}
    assert {t: got[100 * i] for i, t in enumerate(FRESH + sound) if i >= len(FRESH) and got[100 * i]} == {}


def test_words_of_filler_are_learned(spark):
    """Words nobody listed are filler where they stand beside imitation Latin; a sound text that quotes some of it is content."""
    made = "vonk trasel mirdo plenk ostrum".split()
    rows = [(i, " ".join([made[i % 5], "lorem", made[(i + 1) % 5], "ipsum", made[(i + 2) % 5], "dolor"]), "ab"[i % 2]) for i in range(20)]
    rows += [(50, "Trasel vonk mirdo plenk, ostrum vonk trasel.", "a"), (51, "The word vonk stands in the lorem fixture of the parser.", "a"), (52, "trasel vonk", "b")]
    got = {r.id: r.residue for r in residue.classified(spark.createDataFrame(rows, "id int, text string, source string"), "text", "source").collect()}
    assert got == {**{i: "filler" for i in range(20)}, 50: "filler", 51: None, 52: None}
