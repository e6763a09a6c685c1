"""Every tag of a text is evaluated, wherever it stands, as far as it is well-formed."""

import pytest

from monthwise.llm import licenses


def test_every_tag_of_a_line():
    got = licenses.scan_text("/* SPDX-License-Identifier: MIT */ x=1; /* SPDX-License-Identifier: GPL-2.0-only */ "
                             "spdx license identifier = AGPL-3.0\nSPDX-License-Identifier:\nEPL-2.0", licenses.automaton())
    assert got["expressions"] == ["MIT */ x=1; /*", "GPL-2.0-only */", "AGPL-3.0"]
    assert got["labels"] == ["agpl-3.0", "gpl-2.0-only", "mit"]
    assert got["obligations"] == ["copyleft", "network-copyleft", "permissive"]
    assert got["score"] == pytest.approx(1 - 0.05**3)


@pytest.mark.parametrize("text,ids,kind", [
    ("GPL-2.0-only OR (commercial terms)", ["gpl-2.0-only"], "copyleft"),
    ("MIT OR", ["mit"], "permissive"),
    ("MIT AND AND GPL-2.0", ["mit"], "permissive"),
    ("(MIT OR Apache-2.0) AND (EPL-2.0 OR", ["apache-2.0", "mit"], "permissive"),
    ("MIT OR GPL-2.0 AND (x", ["gpl-2.0", "mit"], "permissive"),
])
def test_unfinished_tails_leave_the_start(text, ids, kind):
    got = licenses.scan_text("SPDX-License-Identifier: " + text, licenses.automaton())
    assert (got["labels"], got["obligations"], got["expressions"]) == (ids, [kind], [text])


@pytest.mark.parametrize("text", ["", "AND MIT", "(MIT", "()", ") MIT"])
def test_no_expression_at_the_start(text):
    got = licenses.scan_text("SPDX-License-Identifier: " + text, licenses.automaton())
    assert got["labels"] == got["expressions"] == got["obligations"] == []


def test_many_tags_and_brackets_take_linear_time():
    text = "SPDX-License-Identifier: MIT " * 20_000 + "SPDX-License-Identifier: " + "(" * 50_000 + "MIT"
    got = licenses.scan_text(text, licenses.automaton())
    assert len(got["expressions"]) == 20_000 and got["labels"] == ["mit"]
