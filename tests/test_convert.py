import pytest
from pyspark.sql import functions as F

from docstrata.convert import dialects as D
from docstrata.convert.engine import attributes
from docstrata.convert.html_docs import html_to_markdown
from docstrata.convert.jsvalues import Unreadable, exported, literal
from docstrata.convert.registry import converted, validated


def test_literals():
    assert literal('{a: 1, "b": [true, null, "x\\n", `t`, -2.5], c: {d: \'q\',},}') == {"a": 1, "b": [True, None, "x\n", "t", -2.5], "c": {"d": "q"}}
    assert exported("const Y = 'q';\nexport const X = [{a: Y, b: <b>hi  x</b>}];\nconst A = B;\nconst B = A;") == {"Y": "q", "X": [{"a": "q", "b": "<b>hi x</b>"}]}
    assert literal("() => ([1])") == [1]
    for bad in ("foo()", "{a", "[1 2]", "`${x}`", ""):
        with pytest.raises(Unreadable):
            literal(bad)


def test_attributes():
    p = attributes(" a=\"x > y\" b='q' c={[1]} d {...rest} e=bare f={g(1)}")
    assert {k: v for k, v in p.items() if k != "f"} == {"a": "x > y", "b": "q", "c": [1], "d": True, "e": "bare"} and not p.readable


def test_vitepress():
    text = '---\ntitle: T\ndescription: About\n---\n<div class="x">Hi <Badge text="new" /></div>\n\n::: warning Careful\nbody\n:::\n\n::: details More\ninner\n:::\n\n```\n::: tip\n```\n::: tip\nopen'
    assert D.vitepress(text) == "# T\n\nAbout\n\nHi new\n\n> [!WARNING]\n> **Careful**\n>\n> body\n\nMore\n\ninner\n\n```\n::: tip\n```\n::: tip\nopen\n"
    assert D.vitepress("---\n\njust a rule\n\n---\n") == "---\n\njust a rule\n\n---\n"


def test_mdx():
    text = "---\ntitle: M\n---\nimport X from 'y';\n{/* c -- d */}\n\n:::note[Hey]\ntext\n:::\n\n<Tabs>\n  <TabItem label=\"A\">\n    one\n  </TabItem>\n</Tabs>\n<Foo bar={1} />\n"
    assert D.mdx(text) == "# M\n\n<!-- c == d -->\n\n> [!NOTE]\n> **Hey**\n>\n> text\n\n**A**\n\none\n"


def test_components():
    steps = '<Steps>\n  <Step title="One">\n    First.\n  </Step>\n  <Step title="Two">\n    ```sh\n    run\n    ```\n  </Step>\n</Steps>\n'
    assert D.components(steps) == "1. **One**\n\n   First.\n2. **Two**\n\n   ```sh\n   run\n   ```\n"
    assert D.components('<Note>\nHi\n</Note>\n\n<Tip>open') == "> [!NOTE]\n> Hi\n\n<Tip>open\n"
    assert D.components('<CardGroup><Card title="C" href="/x">go</Card></CardGroup>', lambda h: "up" + h) == "**[C](up/x)**\n\ngo\n"
    assert D.components('export const Z = [{k: "a|b", v: 2}];\n\n<Update label="1.0" tags={["a", "b"]}>\nx\n</Update>') == "| k | v |\n| --- | --- |\n| a\\|b | 2 |\n\n## 1.0 (a, b)\n\nx\n"


def test_astro():
    assert D.astro('<ConfigTable options={[{key: "a", type: "s", description: "d|e"}]} />') == "| Key | Type | Description |\n| --- | --- | --- |\n| `a` | `s` | d\\|e |\n"
    assert D.astro("<ConfigTable options={foo()} />") == "<ConfigTable options={foo()} />\n"
    matrix = '<PlanFeatureMatrix data={{plans: [{id: "p", label: "P"}, {id: "q"}], sections: [{title: "S", features: [{name: "F", availability: {p: true}}]}]}} />'
    assert D.astro(matrix) == "### S\n\n| Feature | P | q |\n| --- | --- | --- |\n| F | Supported | — |\n"
    assert D.astro('<FileTree tree={[{name: "src", children: [{name: "a.py", comment: "x"}]}]} />') == "```text\nsrc\n  a.py  # x\n```\n"
    table = '<TableWrapper><table><tr><th>A</th><th align="right">B</th></tr><tr><td>1</td></tr></table></TableWrapper>'
    assert D.astro(table) == "| A | B |\n| --- | ---: |\n| 1 |  |\n"
    assert D.astro('<ContentModeSwitch id="cli">\nx\n</ContentModeSwitch>\n<ContentModeSwitch id="cli">\ny\n</ContentModeSwitch>').count('<a id="cli-2"></a>') == 1


def test_html():
    page = '<body><nav>n</nav><article><h1><p>T</p></h1><p>a <b>bold</b> <a href="/x y">l</a></p><pre class="language-js!"><code>a\n```\nb<br>c<!-- d --></code></pre><ul><li>x<ul><li>y</li></ul></li></ul><table><tr><th>h</th></tr><tr><td>c|d</td></tr></table></article>'
    assert html_to_markdown(page) == "# T\n\na **bold** [l](</x y>)\n\n````js\na\n```\nb\nc\n````\n\n- x\n  - y\n\n| h |\n| --- |\n| c\\|d |\n"
    tabs = '<div><div role="tablist"><span role="tab">One</span><span role="tab">Two</span></div><div role="tabpanel"><p>a</p></div><div role="tabpanel"><p>b</p></div></div>'
    assert html_to_markdown(tabs) == "**One**\n\na\n\n**Two**\n\nb\n"
    assert html_to_markdown("") == "\n" and html_to_markdown("2 < 3 & 4") == "2 < 3 & 4\n"


def test_columns_keep_errors_with_their_page(spark):
    from docstrata.convert import registry

    registry.register("broken", lambda t: 1 / 0)
    df = spark.createDataFrame([(1, "<h1>A</h1><p>b</p>"), (2, None), (3, "<p>no heading</p>")], "id int, body string")
    assert df.select(converted(F.col("body"), "broken").alias("c")).where("c.error like 'ZeroDivision%'").count() == 2
    pages, failures = validated(df, "html")
    assert [(r.id, r.title) for r in pages.collect()] == [(1, "A")]
    assert sorted((r.id, r.error) for r in failures.collect()) == [(2, "no text"), (3, "not Markdown")]


def test_long_attributes_stay_in_their_tag():
    assert html_to_markdown(f"<h1>T</h1><div data-props=\"{'x' * 9000}\"><p>a <img src='data:{'y' * 9000}'>b</p></div>") == "# T\n\na b\n"
    for unit in ('<a "', "<a '", "<a \"'", "'<a \"' \""):
        assert timed(unit * 8000) < 8 * timed(unit * 2000) + 0.5


def timed(page):
    import time

    began = time.process_time()
    html_to_markdown(page)
    return time.process_time() - began


def test_deep_values_are_read():
    from docstrata.convert.jsvalues import Unreadable, literal

    value = literal("[" * 190 + "1" + "]" * 190)
    for _ in range(190):
        (value,) = value
    assert value == 1
    with pytest.raises(Unreadable):
        literal("[" * 5000 + "]" * 5000)
