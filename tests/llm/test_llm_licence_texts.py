"""Licence templates reach their last mandatory word."""

from gazette.llm import licenses

CLAUSE_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""


def plain(label):
    return licenses.TEMPLATES[label].replace("[[", "").replace("]]", "").replace("{{holder:1-12}}", "the copyright holders and contributors")


def labels(text):
    _, found = licenses.scan_text(text.encode(), (), tuple(licenses.TEMPLATES.items()))
    return {m[0] for m in found}


def test_bsd_3_is_no_bsd_2():
    two = plain("bsd-2-text")
    end = "provided with the distribution."
    assert end in two
    assert labels(two) == {"bsd-2-text"}
    assert labels(two.replace(end, f"{end} {CLAUSE_3}")) == {"bsd-3-text"} == labels(plain("bsd-3-text"))


def test_what_follows_the_conditions_counts():
    for label in ("mit-text", "isc-text", "bsd-2-text", "bsd-3-text"):
        text = plain(label)
        words = text.split()
        assert labels(text) == labels(text.upper()) == {label}
        assert labels(" ".join(words[:-1])) == set(), label
        assert labels(" ".join([*words[:-4], "not", *words[-4:]])) == set(), label
        # the warranty wording is mandatory
        assert labels(text.replace("merchantability", "")) == set(), label
