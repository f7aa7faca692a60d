import sys
import time
from pathlib import Path

import pytest

from docstrata.llm import residue as R
from docstrata.llm.slots import has_slot

SLOTS = ["{{ page.title }}", "{{name}}", "{{ a | default }}", "{{#list}}", "${ user }", "#{x.y}", "<%= title %>", "%%DATE%%", "@@NAME@@", "&&X_Y&&", "::SLUG::", "XX_TITLE_XX", "$PAGE_NAME$", "{slug}", "{0} of {1}", "[YOUR NAME]", "[INSERT TITLE HERE]", "(TITLE to be filled in)", "{% block x %}{% endblock %}", "%(name)s", "undefined undefined", "[object Object]"]
NO_SLOTS = ["`{{ x }}`", "```\n${HOME}\n```", "<pre>{{ a }}</pre>", "\\emph{word} and $n_{i}$", "\\begin{verbatim}\n{{x}}\n\\end{verbatim}", "R&D [see appendix]", "costs $5 to $9", "Set max_length to 88; 50% of it", "the value is undefined", "[[page]] and [text](url)"]


@pytest.mark.parametrize("slot", SLOTS)
def test_slots(slot):
    assert has_slot(slot) and R.is_residue(f"Once the team has {slot} to read, all is well.")


@pytest.mark.parametrize("text", NO_SLOTS)
def test_no_slots(text):
    assert not R.is_residue(text + "\n\nA sentence that stays as it is, with words.")


MESSAGES = ["404 - This page could not be found. Check the address or go back to the start.", "# Title\n\nAccess denied. Reference 0a1b2c3d4e", "<html><head><title>x</title></head><body><p>Please enable JavaScript to continue.</p></body></html>", "<noscript>Loading... (requires JS)</noscript><div id='root'></div>", "Internal error: handler x raised a KeyError\n  at line 4\n  at line 8\nrequest abc123def0", "TBD. TBD. TBD.", "## A\n\nComing soon.\n\n## B\n\n(content pending)", "Lorem ipsum dolum amerit. Vandor trigo cundit.", "ZUGRIFF VERWEIGERT. VORGANG 0A1B2C3D4E", "Veuillez activer JavaScript pour lire cette page.", "Title\n=====\n\nTo do: write this page.", "blah blah blah blah To do: write this page.", "xxx xxx xxx index xxx Coming soon."]
CONTENT = ['A message such as "Access denied" in the log means that the token has run out.', "Error 404 is shown when a page is missing, which the next section explains in detail.\n\nMore text follows here.", "# Only a heading", "", "   ", "blah blah blah blah The mirror keeps three copies.", "As long as the map is old, its readers cannot load the list.", "Nothing on this page says \"coming soon\", since each section is finished."]


@pytest.mark.parametrize("text", MESSAGES)
def test_messages(text):
    assert R.is_residue(text)


@pytest.mark.parametrize("text", CONTENT)
def test_content(text):
    assert not R.is_residue(text)


def test_elements():
    bad = ["a/{{slug}}", "undefined", "TBD", "404 Not Here: page missing", "Service unavailable", "your-page-here", "lorem-ipsum vandor", "<html><body>Error</body></html>", "502 upstream gave no answer"]
    good = [None, "", " ", "errors/404", " guides/enable-javascript ", "GUIDES/A-B", "./a/b.md", "plugins/undefined-values", "start/lorem", "/a/b/"]
    assert [R.is_bad_element(x) for x in bad] == [True] * len(bad) and [R.is_bad_element(x) for x in good] == [False] * len(good)


def test_texts_that_are_not_of_the_tables():
    sys.path.insert(0, str(Path(__file__).parent))
    import evidence_texts as T

    missed = [m for m in T.MESSAGES + T.HELD_OUT_MESSAGES if not R.says_nothing(m)]
    wrong = [c for c in T.CONTENTS + T.HELD_OUT_CONTENTS if R.says_nothing(c)]
    assert len(missed) <= 2 and not wrong, (missed, wrong)


def test_boilerplate_decides(spark, rows):
    """The same two lines are residue where the first is the host's navigation, and content where no other page has it."""
    numbers = "one two three four five six seven eight nine ten".split()
    page = "Home / Docs\nA sentence number {} about things that matter."
    data = [(n, "h", page.format(numbers[n % 10] * (1 + n // 10))) for n in range(40)]
    data += [(100, "h", "Home / Docs\nAccess denied."), (101, "other", "Home / Docs\nAccess denied."), (102, "h", None), (103, None, "Access denied."), (104, "h", ""), (104, "h", ""), (105, "h", "y" * 300_000)]
    df = spark.createDataFrame(data, "id long, host string, body string").selectExpr("*", "1 as recurrent", "'x' as is_residue", "2 as line", "3 as records")
    got = R.residue_records(df, "id", "host", "body")
    assert got.count() == len(data) and rows(got.where("is_residue"), "id") == [(100,), (103,)]
    assert rows(R.without_residue(df, "id", "host", "body").where("id >= 100"), "id") == [(101,), (104,), (104,), (105,)]
    assert R.residue_records(df.where("false"), "id", "host", "body").count() == 0
    assert not R.is_residue("Home / Docs\nAccess denied.") and R.is_residue("Home / Docs\nAccess denied.", True, [0])


def test_small_hosts_and_copies(spark, rows):
    """Three different bodies make a line recur, also in a host of three; copies of one body make nothing recur, however many."""
    quoting = "How the gate works\nForbidden.\nThat is its whole answer to people without a key."
    data = [(n, "three", f"Our menu bar\nA page on topic {w}.") for n, w in enumerate(("a", "b"))] + [(2, "three", "Our menu bar\nUnder construction")]
    data += [(10 + n, "copies", quoting) for n in range(60)]
    df = spark.createDataFrame(data, "id long, host string, body string")
    assert rows(R.residue_records(df, "id", "host", "body").where("is_residue"), "id") == [(2,)]
    found = {r.host: (r.records, len(r.recurrent or [])) for r in R.boilerplate(df, "host", "body").collect()}
    assert found == {"three": (3, 1), "copies": (60, 0)}


def test_many_hosts_take_the_other_join(spark, rows, monkeypatch):
    data = [(n, f"h{n % 7}", f"Site menu\nA page about topic {'x' * n}." if n % 5 else "Site menu\nForbidden.") for n in range(140)] + [(900, None, "Forbidden."), (901, "h1", None)]
    df = spark.createDataFrame(data, "id long, host string, body string")
    want = rows(R.residue_records(df, "id", "host", "body"), "id", "is_residue")
    monkeypatch.setattr(R, "small", lambda side: side)
    assert rows(R.residue_records(df, "id", "host", "body"), "id", "is_residue") == want and sum(x[1] for x in want) == 29


@pytest.mark.parametrize("text", ["error " * 50_000, "y" * 300_000, "= " + " " * 100_000, "<a " * 50_000, "page not " * 50_000, "lorem " * 50_000, "1a" * 100_000, "the error, " * 40_000])
def test_long_texts_take_no_more_than_their_share(text):
    began = time.process_time()
    R.says_nothing(text)
    assert time.process_time() - began < 5


def test_lists(spark, rows):
    df = spark.createDataFrame([(1, ["a/b", None, "TBD", "TBD"]), (2, []), (3, None), (None, ["{{x}}"])], "id long, names array<string>").selectExpr("*", "1 as bad", "2 as elem_pos", "3 as _bad2")
    assert rows(R.bad_elements(df, "id", "names"), "id", "elem_pos") == [(1, 2), (1, 3), (None, 0)]
    assert rows(R.without_bad_elements(df, "names"), "id", "names") == sorted([(1, ["a/b", None]), (2, []), (3, None), (None, [])], key=repr)
    assert R.bad_elements(df.where("false"), "id", "names").count() == 0


def test_tags_end_sentences_and_headings_and_comments_say_nothing():
    for body in (
        "<html><body>\n<p>Page not found</p><p>Go back home</p></body></html>",
        "<body>\n<h1>Four words of title</h1><p>Page not found</p></body>",
        "<p>Page not found</p>\n<!-- made by\na tool of many words -->",
        "<p>Page not found\n<a\ntitle=\"a link of many words\"\n></a></p>",
    ):
        assert R.says_nothing(body), body
    assert not R.says_nothing("<body>\n<p>Page not found</p><p>is what a server says of a missing page.</p></body>")
