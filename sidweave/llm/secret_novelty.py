"""Secret scans: fixed patterns, and strings that a dictionary-primed compressor finds new.

Beside the base patterns, a candidate is a run of key characters that stands close behind a sensitive
word. Its novelty is what it adds, per character, to the zstandard size of its surroundings when the
compressor is primed with identifiers and words: names, paths and words from the surroundings cost little, random
keys nearly a byte a character. Candidates of at least NOVEL that no base span overlaps are reported.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import _text
from ._memo import kept

#: The base patterns. Letters of the first match in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, as one or more would find it
KINDS = ("assign", "access", "hex", "novel")
NOVEL, REACH, BEFORE, AFTER, SHORTEST, LONGEST = 0.75, 40, 300, 100, 16, 400
CONTEXT = re.compile(r"passw|pwd|passphrase|secret|token|api.?key|credential|bearer|private.?key|access.?key|auth|signature|session", re.I | re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.\-]+")
#: Names that surround keys in code and settings.
IDENTIFIERS = ("access_key access_token account_id admin api_key apikey app_secret auth_token authorization aws_access_key_id aws_secret_access_key "
               "base64 basic bearer certificate client_id client_secret config connection_string const credential credentials database default "
               "default_password encryption_key environment export export_const github_token header host https://www.example.com/ id import "
               "localhost login master_key my_password new_password null oauth_token os.environ.get( passphrase passwd password placeholder port "
               "postgres:// private_key process.env. public_key redis:// refresh_token remember_token return root secret secret_key secrets self. "
               "service_account session_id session_key session_token settings. signature ssh-rsa static string test_token token undefined user "
               "user_id username value webhook_secret xxxxxxxxxxxxxxxx 00000000 12345678 abcdefghijklmnopqrstuvwxyz 0123456789abcdef "
               "ABCDEFGHIJKLMNOPQRSTUVWXYZ /usr/local/bin/ /etc/ssl/certs/ .pem .json .yaml .env .com .org .net")
#: Words of names, paths and prose, so that long names made of them are known.
WORDS = """about above accept access account action active activity adapter address administrator after against agent allow amount analysis another
answer application archive argument array article assistant async attempt attribute audience auth authenticate authenticated authentication authenticity
authority author authors authorized authorizer available average backend backup balance banner basket because before between binary board body boundary
branch browser buffer build builder bundle business button cache calendar callback campaign cancel capability catalog category certificates chain challenge
change channel character charge check children circumstances city claim class classification cleanup client clock close cloud cluster code collection
column command comment common communication community company compare complete component components compute condition configuration connect connection
console constant constants consumer contact container content context contract control controller convert cookie cookies copy core count counter country
create created creator crypto current customer cycle daemon dashboard data debug decode default definition delegate delete delivery deploy deployment
description design desktop destination detail details developer development device dialog dictionary different digest directory disable discovery display
distribution document documentation domain download driver duration dynamic editor education element email employee enable encode encoding engine entity
entry enum error event example exception exchange execute executor expired expiration export extension external factory failure feature field fields file
files filter final first folder follow format forward frame framework frontend function functions gateway general generate generated generator global grant
group guide handler hash header headers health hello helper helpers history home hook hooks host hours http https human identifier identity image images
implementation important include index individual info information initial inline input insert install instance integer integration interceptor interface
internal international internationalization interval invalid invoice issue issuer item iterator java javascript job json keys label language large latest layer layout
level library license light limit link list listener loader local location lock logger logging logout long machine mail main management manager mapper
market master match maximum media member memory message messages metadata method middleware migration minimum mobile mode model models module modules
monitor month move name namespace native network never node node_modules normal notification number object offline online open operation operator option
options order organization origin output owner package page panel parameter parameters parent parse parser partial partner path pattern payload payment
people performance period permission permissions person phone picture pipeline platform player plugin point policy pool position power prefix prepare
previous private process processing processor producer product production profile program project promise property protected protocol provider providers
proxy public publish purchase query queue random range reader receive record recovery redirect reference region register registration registry relation
release reload remote remove render replace reply report repository request required reset resolve resolver resource resources response responsibility
result results retry return review role router routes rule runtime sample scale schedule schema scope screen script search second section security select
sender serializer server servers service services setting settings setup share short shutdown signal signed signer simple single size social software source
spring stack standard start state statement status storage store strategy stream structure student style submit subscription success suffix support switch
symbol sync system table target task team template templates tenant terminal test tests testing text theme thread throttle through ticket time timeout
timestamp title tokens toolkit tools topic total trace track traffic transaction transfer transform transport trigger type types under understanding
unique university update upload usage users utils utility valid validate validation validator variable vendor verification verify verifier version video
view views virtual visible volume wallet warning watch website while widget window without worker workflow wrapper writer written year zone
django doc docs established facebook github google linkedin packages react samesite share state-of-the-art twitter well-known youtube"""

Span = tuple[str, int, int, int]  # kind, start, end, start of the secret itself


def base_spans(text: str) -> list[Span]:
    low, out = text.lower(), []
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return out


def _compressor() -> zstandard.ZstdCompressor:
    """One for the life of the worker; a cached function would be shipped by name, which needs an installed copy."""
    held = kept("novelty")
    if "compressor" not in held:
        words = " ".join(WORDS.split())
        primer = zstandard.ZstdCompressionDict(f"{words.upper()} {words.title()} {words} {IDENTIFIERS}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held["compressor"] = zstandard.ZstdCompressor(level=6, dict_data=primer, write_checksum=False, write_content_size=False, write_dict_id=False)
    return held["compressor"]


def novelty(text: str, start: int, end: int) -> float:
    """Marginal compressed bytes per character of text[start:end] against its surroundings."""
    around = (text[max(0, start - BEFORE):start] + "\n" + text[end:end + AFTER] + "\n").encode("utf-8", "replace")
    own = text[start:end].encode()
    return (len(_compressor().compress(around + own)) - len(_compressor().compress(around))) / len(own)


def novel(text: str, start: int, end: int) -> bool:
    """Whether a run reaches NOVEL: as a whole, or, if over LONGEST, in any of its stretches of LONGEST and of
    2 * SHORTEST characters, which overlap by SHORTEST; the last of either kind is flush with the end."""
    if end - start <= LONGEST:
        return novelty(text, start, end) >= NOVEL
    return any(novelty(text, s, s + n) >= NOVEL for n in (LONGEST, 2 * SHORTEST) for s in (*range(start, end - n, n - SHORTEST), end - n))


def novel_spans(text: str, base: list[Span]) -> list[Span]:
    """Runs of SHORTEST characters or more that begin within REACH behind a sensitive word, whatever characters they hold.

    Sensitive words inside a run begin later candidates of the same run. A run is measured from its first candidate
    on, and from later ones only if that did not reach NOVEL and at most LONGEST characters are left, as the first
    one's stretches cover what lies before; so a run costs time in proportion to its length.
    """
    ordered = sorted((a, b) for _, a, b, _ in base)
    starts, reach = [a for a, _ in ordered], list(accumulate((b for _, b in ordered), max))
    out, begins, ends, over, seen = [], [], [], [], set()  # known runs in order; over: nothing more to measure in it
    for near in CONTEXT.finditer(text):
        at, stop = near.end(), min(len(text), near.end() + REACH)
        while m := CANDIDATE.search(text, at, stop):
            s = m.start()
            k = bisect_right(begins, s) - 1
            if k < 0 or s >= ends[k]:
                begins.append(s)
                ends.append(CANDIDATE.match(text, s).end())
                over.append(False)
                k = len(ends) - 1
            at = e = ends[k]
            if over[k] or e - s < SHORTEST or s in seen or (e - s > LONGEST and s > begins[k]):
                continue
            seen.add(s)
            hit = bisect_right(starts, e - 1) - 1
            if hit >= 0 and reach[hit] > s:  # a base span overlaps
                continue
            if novel(text, s, e):
                out.append(("novel", s, e, s))
                over[k] = True
    return out


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base, all) spans, by start and then kind."""
    base = base_spans(text)
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    return sorted(base, key=order), sorted(base + novel_spans(text, base), key=order)


def _joined(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)


SCANNED = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCANNED.split(", ")]
    for batch in batches:
        for at, texts in _text.slices(batch):
            rows = []
            for t in texts:
                base, found = spans(t)
                count = [sum(k == kind for k, *_ in base) for kind in KINDS[:3]]
                rows.append((*count, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *(pa.array(c, pa.int64()) for c in cols[:3]),
                                              *(pa.array(c, pa.string()) for c in cols[3:])], names)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans per row.

    NULL and empty texts have no spans (the digest is that of the empty string). Repeated rows give
    repeated results; a NULL id is kept; other columns are ignored; an empty table gives an empty result.
    """
    return _text.rows(docs, id_col=id_col, text_col=text_col).mapInArrow(_scan, SCANNED)


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with the secret part of every span replaced; overlapping parts are replaced together."""
    out, at = [], 0
    for _, _, end, start in sorted(spans(text)[1], key=lambda x: (x[3], x[2])):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]]) if at else text


def redact(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """All rows, with secrets replaced where the rows are read; size_col follows the text if it is there. NULL stays NULL."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, at = batch.columns, names.index(text_col)
            given = cols[at].to_pylist()
            made = [None if t is None else redacted(t) for t in given]
            cols[at] = pa.array(made, cols[at].type)
            if size_col in names and any(a != b for a, b in zip(given, made)):
                k = names.index(size_col)
                sizes = [n if a == b else len(b) for n, a, b in zip(cols[k].to_pylist(), given, made)]
                cols[k] = pa.array(sizes, cols[k].type)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
