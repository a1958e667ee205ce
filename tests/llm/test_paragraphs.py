import random

import numpy as np
import pytest

from dqspark.llm import paragraphs
from dqspark.llm.paragraphs import drop_paragraphs, lines_of, near_paragraphs, tuned_bands
from tests.llm.tables import make_docs, prose


DATA = "/root/testdata/sf0.01/documents.parquet"


def line(seed, n):
    return prose(seed, n).replace("\n", "")


def slow(rows):
    """(id, line) -> place that stays, for each paragraph that goes."""
    places = {}
    for key, text in rows:
        for i, words in lines_of(text):
            places.setdefault(tuple(words), []).append((key is None, key, i))
    nodes = list(places)
    bags = [{w[i : i + 5] for i in range(max(1, len(w) - 4))} for w in nodes]
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if len(bags[i] & bags[j]) >= 0.8 * len(bags[i] | bags[j]) - 1e-9:
                root[find(i)] = find(j)
    least = {}
    rank = lambda p: (p[0], p[1] or 0, p[2])
    for i, n in enumerate(nodes):
        least[find(i)] = min([least.get(find(i)), *places[n]], key=lambda p: rank(p) if p else (True, 1 << 60, 0))
    out = {}
    for i, n in enumerate(nodes):
        stays = least[find(i)]
        out |= {p[1:]: stays[1:] for p in places[n] if rank(p) != rank(stays)}
    return out


def varied(seed, copies=70, size=70):
    """One long line in many versions, among others."""
    rng = random.Random(seed)
    base = line(seed, size).split()
    rows = []
    for i in range(copies):
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
        rows.append((i, "\n".join([line(100 + i, 12), " ".join(words), rng.choice(["short line", "A b, c d", ""])])))
    return rows


@pytest.mark.parametrize("cell", [paragraphs.CELL, 3, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_like_all_pairs(spark, monkeypatch, cell, seed):
    monkeypatch.setattr(paragraphs, "CELL", cell)
    monkeypatch.setattr(paragraphs, "PROBES", 8)
    monkeypatch.setattr(paragraphs, "MEMBERS", 16)
    rows = varied(seed, size=70 if seed == 1 else 44)
    found = {}
    for r in near_paragraphs(make_docs(spark, rows).repartition(4)).collect():
        found |= {(r.id, x.line): (x.first_id, x.first_line) for x in r.removed}
    assert found == slow(rows)


def test_awkward_rows(spark, awkward, nothing):
    found = near_paragraphs(awkward).collect()
    assert len(found) == awkward.count()
    expected = slow([(r.doc_id, r.text) for r in awkward.collect()])
    for r in found:
        # Equal rows are told by one place; the null id comes after all others.
        assert {(r.id, x.line): (x.first_id, x.first_line) for x in r.removed} == {
            k: v for k, v in expected.items() if k[0] == r.id and r.n_paragraphs > 0
        }
    cut = drop_paragraphs(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] == awkward.first().text and texts[3] is None and texts[5] == " \n\t \n"
    assert texts[2] == "\n".join(x for x in awkward.first().text.split("\n") if len(x.split()) < 5)
    assert near_paragraphs(nothing).count() == 0 and drop_paragraphs(nothing).count() == 0


def slow_parts(rows, removed):
    """(id, line, start, stop) -> first place, for each repeated part of a line that stays."""
    places, known = {}, paragraphs.WordHashes()
    for key, text in rows:
        for i, words in lines_of(text):
            if len(words) > paragraphs.LONG:
                pairs = [int(x) for x in paragraphs._mixed(np.array([known[w] for w in words[:-1]], np.uint64) * paragraphs._MIX + np.array([known[w] for w in words[1:]], np.uint64))]
                cuts = {0, len(words)}
                for at in range(len(pairs) - paragraphs.WINDOW + 1):
                    view = pairs[at : at + paragraphs.WINDOW]
                    cuts.add(at + view.index(min(view)))
                cuts = sorted(cuts)
                for a, b in zip(cuts, cuts[1:]):
                    if b - a >= paragraphs.LEAST_PART:
                        places.setdefault(tuple(words[a:b]), []).append((key, i, a, b))
    out = {}
    for all_places in places.values():
        first = min(all_places)
        out |= {p: first[:3] for p in all_places if p != first and p[:2] not in removed}
    return out


def test_a_passage_inside_a_long_line_is_found(spark):
    passage = line(77, 55)
    rows = [(i, f"{line(200 + i, 300)} {passage} {line(300 + i, 250)}") for i in range(6)]
    rows += [(10 + i, line(400 + i, 500)) for i in range(4)] + [(20, passage), (21, "short equal line\n" + line(9, 20)), (22, "short equal line")]
    found = {r.id: r for r in near_paragraphs(make_docs(spark, rows).repartition(3)).collect()}
    got = {(i, p.line, p.start, p.stop): (p.first_id, p.first_line, p.first_start) for i, r in found.items() for p in r.parts}
    assert got == slow_parts(rows, {(i, x.line) for i, r in found.items() for x in r.removed})
    assert {i for i, r in found.items() if r.parts or r.removed} == {1, 2, 3, 4, 5}
    cut = {r.doc_id: r.text for r in drop_paragraphs(make_docs(spark, rows)).collect()}
    for i in range(1, 6):
        lost = len(rows[i][1].split()) - len(cut[i].split())
        assert 20 <= lost <= 55 and cut[i].startswith(line(200 + i, 300).rsplit(" ", 40)[0])
    assert all(cut[i] == t for i, t in rows if i in (0, 10, 11, 12, 13, 20, 21, 22))


def test_recall_of_shared_runs(spark):
    """Documents of the tables that share 50 words with an earlier one lose something."""
    docs = spark.read.parquet(DATA)
    seen, sharing = {}, set()
    for r in docs.orderBy("doc_id").collect():
        words = paragraphs._words((r.text or "").lower())
        runs = {hash(tuple(words[i : i + 50])) for i in range(len(words) - 49)}
        if any(seen.get(h, r.doc_id) != r.doc_id for h in runs):
            sharing.add(r.doc_id)
        for h in runs:
            seen.setdefault(h, r.doc_id)
    hit = {r.id for r in near_paragraphs(docs).where("size(removed) > 0 OR size(parts) > 0").collect()}
    recall = len(sharing & hit) / len(sharing)
    print(f"recall {recall:.3f} of {len(sharing)}")
    assert recall >= 0.9


def test_bands_reach_the_recall():
    for similarity, rows, recall in ((0.8, 3, 0.99), (0.7, 4, 0.95)):
        bands = tuned_bands(similarity, rows, recall)
        assert 1 - (1 - similarity**rows) ** bands >= recall > 1 - (1 - similarity**rows) ** (bands - 1)
