"""Licences and preference pairs against plain searches."""

from collections import Counter

import pytest

from grantlens.llm import licences, preference


def dice(a, b):
    one, other = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    return 2 * sum((one & other).values()) / (sum(one.values()) + sum(other.values()))


def plain_licences(text, templates, threshold):
    words = [(m.group().lower(), *m.span()) for m in licences._WORD.finditer(text)]
    plain = [w[0] for w in words]
    found = []
    for order, (name, wording) in enumerate(templates.items()):
        own = licences._WORD.findall(wording.lower())
        for i in range(len(plain)):
            for j in range(i + 2, len(plain) + 1):
                score = dice(plain[i:j], own)
                if score >= threshold:
                    found.append((-score, i, j, order, name))
    taken, out = [], []
    for score, i, j, _, name in sorted(found):
        if all(j <= low or high <= i for low, high in taken):
            taken.append((i, j))
            out.append((words[i][1], words[j - 1][2], name, -score))
    return sorted(out)


SHORT = {name: text for name, text in licences.TEMPLATES.items() if len(text) < 80}
TEXTS = [
    "", "All rights reserved.", "x y. ALL  RIGHTS\nRESERVED! z", "rights all reserved",
    "Licensed under the Apache License, Version 2.0. Released under the MIT License.",
    "This work is licenced under the GNU General Public License, version 3. all rights reserved all rights reserved",
    "so licensed under the the Apache Licence version 2.0 of the year", "İ all rights reserved İ",
]


@pytest.mark.parametrize("threshold", [0.6, 0.8, 1.0])
def test_licences(make_docs, threshold):
    got = {}
    for r in licences.licences(make_docs(TEXTS), templates=SHORT, threshold=threshold).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end, r.licence, r.dice))
    for i, text in enumerate(TEXTS):
        assert sorted(got.get(i, [])) == plain_licences(text, SHORT, threshold), text


def test_long_templates_are_found_in_long_texts(make_docs, odd_docs, no_docs):
    text = "lorem ipsum of the " * 3000 + licences.TEMPLATES["MIT"].replace("hereby ", "") + " of the" * 3000
    rows = licences.licences(make_docs([text])).collect()
    assert [r.licence for r in rows] == ["MIT"] and rows[0].dice > 0.95
    assert licences.licences(odd_docs).count() == licences.licences(no_docs).count() == 0


def conversation(*turns):
    return [(i, role, text) for i, (role, text) in enumerate(turns)]


U, A = "user", "assistant"


def test_preference_pairs(spark):
    first = conversation((U, "hi"), (A, "hello"), (U, "more"), (A, "good"))
    second = conversation((U, "hi"), (A, "hello"), (U, "more"), (A, "bad"), (U, None))
    cases = {
        1: (first, second), 2: (first, first), 3: (first, first[:2]), 4: (first, []), 5: (second, conversation((A, "hi"))),
        6: (conversation((None, None)), conversation(("", ""))),
    }
    rows = [
        (pair, side, *turn, "x")
        for pair, sides in cases.items()
        for side, turns in zip(("chosen", "rejected"), sides)
        for turn in turns + turns[:1]
    ]
    rows += [(None, "chosen", 0, U, "x", "x"), (9, "other", 0, U, "x", "x"), (9, "chosen", None, U, "x", "x")]
    turns = spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string, c string")
    got = {r.pair_id: r for r in preference.preference_pairs(turns).collect()}
    assert set(got) == set(cases)
    show = lambda t: f"<|im_start|>{t[1] or ''}\n{t[2] or ''}<|im_end|>\n"
    for pair, (chosen, rejected) in cases.items():
        n = 0
        plain = [[(r or "", t or "") for _, r, t in side] for side in (chosen, rejected)]
        while n < min(map(len, plain)) and plain[0][n] == plain[1][n]:
            n += 1
        r = got[pair]
        assert r.n_common == n and r.prompt == "".join(map(show, chosen[:n]))
        assert (r.chosen, r.rejected) == ("".join(map(show, chosen[n:])), "".join(map(show, rejected[n:])))
        for text, mask, side in ((r.chosen, r.chosen_mask, chosen), (r.rejected, r.rejected_mask, rejected)):
            assert [text[m.start : m.end] for m in mask] == [f"{t}<|im_end|>\n" for _, role, t in side[n:] if role == A]
    assert preference.preference_pairs(turns.limit(0)).count() == 0


NAMED = {
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU General Public License v3.0.": "GPL-3.0",
    "This work is licensed under the GNU General Public License.": "GPL",
    "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
    "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    licences.TEMPLATES["GPL-3.0-header"].replace("version 3", "version 2"): "GPL-2.0-header",
    licences.TEMPLATES["GPL-3.0-header"].replace("General", "Affero General"): "AGPL-3.0-header",
    licences.TEMPLATES["GPL-3.0-header"].replace("General", "Lesser General").replace("n 3", "n 2.1"): "LGPL-2.1-header",
    "Licensed under CC BY 3.0.": "CC-BY-3.0",
    "Licensed under CC BY-NC.": "CC-BY-NC",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0-long",
    "This work is licensed under a Creative Commons Attribution-Non-Commercial 3.0 Unported License.": "CC-BY-NC-3.0-long-b",
    licences.TEMPLATES.get("MPL-2.0-header", ""): "MPL-2.0-header",
    licences.TEMPLATES.get("BSD-2-Clause", ""): "BSD-2-Clause",
    licences.TEMPLATES.get("BSD-3-Clause", "").replace("the copyright holder", "the University"): "BSD-3-Clause",
    licences.TEMPLATES.get("CC0-mark", ""): "CC0-mark",
    licences.TEMPLATES.get("Unlicense", ""): "Unlicense",
    licences.TEMPLATES.get("Apache-2.0-text", ""): "Apache-2.0-text",
    "Licensed under the Apache License, Version 1.0.": None,
}


def test_licences_by_version_and_family(make_docs):
    got = {r.doc_id: r.licence for r in licences.licences(make_docs([f"so {t}\nthen more" for t in NAMED])).collect()}
    assert [got.get(i) for i in range(len(NAMED))] == list(NAMED.values())


def test_pairs_share_all_but_the_last_answer(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "bye"),
        (2, 0, "user", "q"), (2, 1, "assistant", "c"), (2, 1, "assistant", "d"),
        (3, 0, "user", "alone"), (3, 1, None, None), (5, 0, "assistant", "b"), (6, 0, "assistant", "b"),
        (None, 0, "user", "x"), (7, None, "user", "x"),
    ]
    conversations = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    wide = conversations.selectExpr("*", "1 AS pair_id", "2 AS side", "3 AS last", "4 AS other")
    for given in (conversations, wide):
        pairs = {row.pair_id: row for row in preference.preference_pairs(preference.answer_pairs(given)).collect()}
        assert set(pairs) == {1, 2, 3, 5, 6}
        assert [pairs[i].n_common for i in (1, 2, 3, 5, 6)] == [3, 1, 2, 1, 0]
        assert pairs[1].chosen == "<|im_start|>assistant\nb<|im_end|>\n"
        assert pairs[1].rejected == "<|im_start|>assistant\nc<|im_end|>\n"
        assert pairs[2].rejected == "" and pairs[2].chosen_mask and not pairs[2].rejected_mask
        assert (pairs[3].chosen, pairs[3].rejected, pairs[5].chosen, pairs[5].rejected) == ("", "", "", "")
        assert pairs[6].chosen == "<|im_start|>assistant\nb<|im_end|>\n"
    assert preference.answer_pairs(conversations.limit(0)).count() == 0


def test_every_pair_of_the_tables_has_a_prompt(spark, small_tables):
    from grantlens.llm.queries import op4_preference_format

    pairs = op4_preference_format(spark, small_tables).collect()
    turns = spark.read.parquet(f"{small_tables}/conversations.parquet").where("conv_id is not null")
    assert len(pairs) == turns.select("conv_id").distinct().count()
    assert sum(row.n_common > 0 for row in pairs) * 2 > len(pairs)
