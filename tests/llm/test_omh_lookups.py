from caseweave.llm import omh as O


def texts():
    one = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcdefgh"]
    return [(i, t) for i, t in enumerate(one)] + [(100, one[3]), (101, one[3] + " more"), (102, None), (103, ""), (None, one[0])]


def test_lookups_hold_only_classes_of_several(docs, monkeypatch):
    """What is looked up, which may be broadcast or repeated, does not grow with the documents that have no copy."""
    sizes, real = [], O.join_lookup

    def seen(left, side, *more):
        sizes.append(side.count())
        return real(left, side, *more)

    monkeypatch.setattr(O, "join_lookup", seen)
    found = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in O.classes(docs(texts())).collect()}
    assert found == {**{i: (i, 1) for i in range(8)}, 3: (3, 3), 100: (3, 3), 101: (3, 3), 102: (102, 2), 103: (102, 2), None: (None, None)}
    assert sizes == [2]
    kept = O.keep_one(docs(texts())).select("doc_id").collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(map(str, [*range(8), 102, None]))
    assert sizes == [2]  # which documents stay does not depend on the classes' sizes
