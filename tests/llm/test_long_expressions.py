"""Licence expressions of any length after a tag."""

from __future__ import annotations

import pytest

from talkloom.llm import license_scan


def scan(text):
    return license_scan.scan_text(text.encode(), license_scan.build_automaton(), license_scan.build_tag_automaton())


@pytest.mark.parametrize("n", [100, 5_000])
@pytest.mark.parametrize("nested", [False, True])
def test_long_expression_is_read_to_its_end(n, nested):
    names = [f"licence-{k}" for k in range(n)]
    expression = " OR (".join(names) + ")" * (n - 1) if nested else "(" + " OR ".join(names) + ")"
    *_, labels, score, expressions, _ = scan(f"// SPDX-License-Identifier: {expression}\nrest of the file")
    assert expressions == [expression] and set(labels.split(",")) == set(names) and score > 0
    tree = license_scan.parse_expression(expression)
    assert license_scan.permitted(tree, {names[-1]}) and not license_scan.permitted(tree, {"other"})


def test_only_identifiers_are_licences():
    """Words after a tag that aren't of an identifier's form end the expression, or are none."""
    for text, labels, expressions, met in (
        ("SPDX-License-Identifier: see the file named COPYING", "", [], None),
        ("<!-- SPDX-License-Identifier: MIT -->", "mit", ["MIT"], True),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND MIT */", "gpl-2.0-only with classpath-exception-2.0,mit", ["GPL-2.0-only WITH Classpath-exception-2.0 AND MIT"], False),
        ("SPDX-License-Identifier: GPL-3.0+ OR ISC see", "gpl-3.0+,isc", ["GPL-3.0+ OR ISC"], True),
        ("SPDX-License-Identifier: LicenseRef-own AND (nothing", "licenseref-own", [], False),
        ("SPDX-License-Identifier: MIT\nspdx-license-identifier: GPL-2.0", "gpl-2.0,mit", ["MIT", "GPL-2.0"], False),
    ):
        row = scan(text)
        assert (row[5], row[7], row[8]) == (labels, expressions, met), text
