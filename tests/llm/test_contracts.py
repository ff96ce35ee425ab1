"""Each registered query of the subpackage against a brute-force version on the smallest tables."""

import base64
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
import xxhash

import __spark_entry__ as entry
from check_oracle import compare, database

FOLDER = "/root/testdata/sf0.001"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{FOLDER}/{name}.parquet'").df().to_dict("records")


@pytest.fixture(scope="module")
def documents():
    return table("documents")


def rows_of(spark, name):
    return entry.queries()[name](spark, FOLDER).collect()


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def brute_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append((m.start(), order, kind, m.end()))
    return sorted(found)


@pytest.mark.parametrize("name", ["op7_line_rules", "op8_url_cascade"])
def test_query_equals_sql(spark, name):
    good, note = compare(spark, database(FOLDER), FOLDER, name)
    assert good, note


def test_quality_ranks_held_out_documents(spark):
    rows = {r.doc_id: r for r in rows_of(spark, "op1_quality_discriminant")}
    assert len(rows) == len(table("documents"))
    for doc_id, row in rows.items():
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    held = [(rows[x["doc_id"]].predicted, x["quality"]) for x in table("labels") if rows[x["doc_id"]].held_out]
    assert np.mean([a == b for a, b in held]) > 0.85


def test_toxicity_scores_and_offsets(spark, documents):
    texts = {d["doc_id"]: d["text"] for d in documents}
    rows = {r.doc_id: r for r in rows_of(spark, "op2_toxic_spans")}
    assert set(rows) == set(texts)
    for doc_id, row in rows.items():
        assert row.predicted == int(row.score >= 0.5)
        assert all(texts[doc_id][a:b].isalpha() for a, b in zip(row.starts, row.ends))


def test_warc_records(spark):
    pages = table("pages")
    first = {}
    for page in pages:
        payload = (page["html"] or "").encode()
        first[payload] = min(first.get(payload, page["page_id"]), page["page_id"])
    got = {r.page_id: r for r in rows_of(spark, "op3_warc")}
    assert len(got) == len(pages)
    for page in pages:
        payload, row = (page["html"] or "").encode(), got[page["page_id"]]
        assert row.payload_bytes == len(payload)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        original = first[payload] == page["page_id"]
        assert (row.record_type, row.refers_to) == (("response", None) if original else ("revisit", first[payload]))


def test_leaks_hold_every_whole_passage(spark, documents):
    items = {b["item_id"]: re.findall(r"\w+", b["text"].lower()) for b in table("benchmark")}
    want = set()
    for d in documents:
        words = " ".join(re.findall(r"\w+", d["text"].lower()))
        want |= {(d["doc_id"], i) for i, w in items.items() if f" {' '.join(w)} " in f" {words} "}
    got = {(r.doc_id, r.item_id) for r in rows_of(spark, "op4_template_leaks")}
    assert want == got


def test_personal_data_base_spans(spark, documents):
    got = {r.doc_id: r for r in rows_of(spark, "op5_personal_data")}
    for d in documents:
        spans, row = brute_spans(d["text"] or ""), got[d["doc_id"]]
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))
        counts = [sum(s[1] == k for s in spans) for k in range(4)]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts


def test_sentencepiece_ids_and_text(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in rows_of(spark, "op6_sentencepiece")}
    for d in documents:
        ids = model.encode(d["text"], add_bos=True, add_eos=True)
        row = got[d["doc_id"]]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_simhash_components(spark, documents):
    prints = {}
    for d in documents:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), d["text"] or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[d["doc_id"]] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for row in rows_of(spark, "op9_simhash"):
        assert row.fingerprint == f"{prints[row.doc_id]:016x}"
        assert row.component_id == find(row.doc_id)


def test_token_files(spark, documents):
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in rows_of(spark, "op10_token_files")}
    start = 0
    for d in sorted(documents, key=lambda d: d["doc_id"]):
        ids = [*tokenizer.encode(d["text"], add_special_tokens=False).ids, 1]
        row = got[d["doc_id"]]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_pipeline_keeps_clean_documents_and_applies_every_stage(spark, documents):
    rows = {r.doc_id: r for r in rows_of(spark, "pipeline")}
    rules = {r.doc_id: r.kept for r in rows_of(spark, "op7_line_rules")}
    leaked = {r.doc_id for r in rows_of(spark, "op4_template_leaks")}
    assert rows and all(rules[i] for i in rows) and not leaked & set(rows)
    for row in rows.values():
        assert row.round_trip and not brute_spans(row.text) and row.n_chars == len(row.text)
    kept_texts = [r.text for r in rows.values()]
    assert len(set(kept_texts)) == len(kept_texts)
