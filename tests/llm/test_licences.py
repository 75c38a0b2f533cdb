from pathlib import Path

import pytest

from fxlake.llm import licences
from tests.llm.conftest import make, prose


def run(spark, documents):
    return sorted(((r.doc, r.whole_text, r.n_lines, r.licences) for r in licences.scan(make(spark, documents)).collect()), key=str)


def test_cases(spark, awkward):
    mit = licences.KNOWN["MIT"][2]
    documents = awkward + [
        (20, mit), (21, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(". ", ".\n")), (22, mit + " plus"),
        (23, prose(1, 30) + "\n  LICENCED under the apache licence -- version 2.0\n" + prose(2, 20)),
        (24, "All rights reserved.\nLicensed under CC BY-NC 4.0."), (25, "Licensed under CC BY-NC 3.0."), (25, "All Rights Reserved"),
        (26, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.")]
    got = [r for r in run(spark, documents) if r[3]]
    assert got == sorted([(20, "MIT", 1, "MIT"), (21, "MIT", 0, "MIT"), (23, None, 1, "Apache-2.0"), (24, None, 2, "All-Rights-Reserved,CC-BY-NC-4.0"),
                          (25, "All-Rights-Reserved", 1, "All-Rights-Reserved"), (26, None, 2, "CC-BY-NC-4.0")], key=str)
    assert len(run(spark, documents)) == len(documents)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_triggers_survive_spacing_and_punctuation(spark):
    documents = [(1, "All  rights  reserved."), (2, "x\nALL RIGHTS\tRESERVED\ny"), (3, "all-rights-reserved"), (4, "All rights\nreserved.")]
    name = "All-Rights-Reserved"
    assert run(spark, documents) == sorted([(1, name, 1, name), (2, None, 1, name), (3, name, 1, name), (4, name, 0, name)], key=str)


@pytest.mark.parametrize("trigger", ["rights reserved", "favor"])
def test_triggers_that_normalisation_changes_are_refused(spark, monkeypatch, trigger):
    monkeypatch.setattr(licences, "TRIGGERS", [*licences.TRIGGERS, trigger])
    with pytest.raises(ValueError):
        licences.known_digests(spark)


def test_whole_licence_texts(spark):
    cargo = "Copyright (c) 2020, Someone\n\n"
    mit = licences.KNOWN["MIT"][2].removeprefix("MIT License ")
    bsd = licences.KNOWN["BSD-2-Clause"][0]
    names = ["Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0"]
    texts = {n: (Path(licences.__file__).parent / "texts" / f"{n}.txt").read_text() for n in names}
    documents = [(k, texts[n]) for k, n in enumerate(names)] + [(10 + k, " ".join(texts[n].upper().split())) for k, n in enumerate(names)]
    documents += [(20, cargo + mit), (21, cargo + bsd), (22, cargo + bsd[:-30]), (23, cargo + licences.KNOWN["ISC"][1])]
    got = {d: whole for d, whole, _, _ in run(spark, documents)}
    assert [got[k] for k in range(6)] == [got[10 + k] for k in range(6)] == names
    assert [got[k] for k in (20, 21, 22, 23)] == ["MIT", "BSD-2-Clause", None, "ISC"]
