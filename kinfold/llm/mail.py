"""The readable body of a raw mail: decoded text without headers, attachments and data lines."""
from __future__ import annotations

import base64
import binascii
import html
import quopri
import re

_HEADER = re.compile(r"(?:[A-Za-z][A-Za-z0-9-]*:[ \t].*|[A-Za-z][A-Za-z0-9-]*:)$")
_START = re.compile(r"\s*(?:From |(?:received|from|to|cc|bcc|date|subject|message-id|mime-version|content-[a-z-]+|x-[a-z-]+|in-reply-to|references|reply-to|return-path|sender):)", re.I)
_BOUNDARY = re.compile(r"boundary=\"?([^\"\s;]+)", re.I)
_TAG = re.compile(r"<(?:style|script)\b.*?</(?:style|script)>", re.I | re.S)
_BREAK = re.compile(r"<(?:br|/p|p|div|/div|/tr|/td|li|/li|/h\d|blockquote|/blockquote)\b[^>]*>", re.I)
_ANY = re.compile(r"<[^>]{0,2000}>")
_B64_LINE = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}$")
_QUOTE = re.compile(r"^(?:[>|]\s?)+", re.M)
_MOJIBAKE = re.compile(r"[ÂÃÅâà][\u0080-¿‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")


def repair(text: str) -> str:
    """UTF-8 that was read as a one-byte encoding, put right run by run where that is possible."""
    if not _MOJIBAKE.search(text):
        return text

    def fix(m: re.Match) -> str:
        run = m[0]
        raw = bytearray()
        for c in run:
            if ord(c) < 256:
                raw.append(ord(c))
            else:
                try:
                    raw += c.encode("cp1252")
                except UnicodeEncodeError:
                    return run
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return raw.decode("utf-8", "ignore") or run

    return _RUN.sub(fix, text)


_RUN = re.compile(r"[\u0080-ÿ‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ€]{2,}")


def _decode(body: str, encoding: str) -> str:
    encoding = encoding.lower()
    if encoding == "quoted-printable":
        raw = quopri.decodestring(body.encode("utf-8", "replace"))
        return raw.decode("utf-8", "replace")
    if encoding == "base64":
        squeezed = re.sub(r"[^A-Za-z0-9+/]", "", body)
        try:
            return base64.b64decode(squeezed[: len(squeezed) // 4 * 4]).decode("utf-8", "replace")
        except (binascii.Error, ValueError):
            return ""
    return body


def _headers(lines: list[str], at: int) -> tuple[dict[str, str], int]:
    """Headers from line `at`, and the line behind them. Folded lines are joined."""
    found: dict[str, str] = {}
    name = ""
    n = len(lines)
    while at < n:
        line = lines[at]
        if not line.strip():
            return found, at + 1
        if line[0] in " \t" and name:
            found[name] += " " + line.strip()
        elif _HEADER.match(line):
            name, _, value = line.partition(":")
            name = name.lower()
            found[name] = value.strip()
        elif name or at == 0 and line.startswith("From "):
            if name:
                return found, at
        else:
            return found, at
        at += 1
    return found, at


def _text_of(headers: dict[str, str], body: str) -> tuple[str, str]:
    """(kind, text): kind is plain, html or '' for what is no text."""
    kind = headers.get("content-type", "text/plain").lower()
    if "attachment" in headers.get("content-disposition", "").lower() or not (kind.startswith("text/") or not kind.strip() or "/" not in kind):
        return "", ""
    text = _decode(body, headers.get("content-transfer-encoding", ""))
    if "html" in kind:
        text = html.unescape(_ANY.sub(" ", _BREAK.sub("\n", _TAG.sub(" ", text))))
        return "html", text
    return "plain", text


def body_of(raw: str | None) -> str:
    """The body's text; '' for a null, blank or bodyless mail. Of alternatives the plain text is taken, else the HTML. Quotation marks
    at line starts are dropped, quoted text stays. A text without headers is all body."""
    if not raw or not raw.strip():
        return ""
    raw = raw.replace("\r\n", "\n").replace("\r", "\n")
    lines = raw.split("\n")
    at = 0
    headers: dict[str, str] = {}
    if _START.match(raw):
        while at < len(lines) and not lines[at].strip():
            at += 1
        headers, at = _headers(lines, at)
    kind = headers.get("content-type", "").lower()
    m = _BOUNDARY.search(headers.get("content-type", ""))
    rest = "\n".join(lines[at:])
    if m is None and not kind.startswith("text/"):
        # the header that names the boundary may be lost
        b = re.search(r"^--(=_\w+|-*=?_?[\w.=-]{8,})[ \t]*\n(?:content-)", rest, re.M | re.I)
        boundary = b[1] if b else ""
    else:
        boundary = m[1] if m else ""
    if not boundary:
        k, text = _text_of(headers, rest) if headers else ("plain", rest)
        if k == "plain" and re.match(r"\s*<(?:!doctype|html|body|p)\b", text, re.I):
            text = html.unescape(_ANY.sub(" ", _BREAK.sub("\n", _TAG.sub(" ", text))))
        return _QUOTE.sub("", repair(text))
    plain, rich = [], []
    first = True
    for part in rest.split("--" + boundary):
        if first:
            first = False
            if part.strip() and not part.strip().lower().startswith("content-"):
                plain.append(part)
            continue
        if part.startswith("--"):
            tail = part[2:].strip("\n")
            if tail.strip():
                plain.append(tail)
            continue
        ls = part.lstrip("\n").split("\n")
        h, z = _headers(ls, 0)
        inner = _BOUNDARY.search(h.get("content-type", ""))
        if inner and "multipart" in h.get("content-type", "").lower():
            text = body_of("Content-Type: " + h["content-type"] + "\n\n" + "\n".join(ls[z:]))
            plain.append(text)
            continue
        k, text = _text_of(h, "\n".join(ls[z:]))
        if k == "plain":
            plain.append(text)
        elif k == "html":
            rich.append(text)
    text = "\n\n".join(plain)
    if len(text.strip()) * 2 < sum(map(len, rich)):
        text += "\n\n" + "\n\n".join(rich) if not text.strip() or rich and text.strip()[:40] not in "\n".join(rich) else ""
        if len(text.strip()) * 2 < sum(map(len, rich)):
            text = "\n\n".join(rich)
    return _QUOTE.sub("", repair(text))


def paragraphs(body: str) -> list[str]:
    """Runs of text lines; lines broken within a sentence are joined, lines of data are left out."""
    out: list[str] = []
    cur: list[str] = []
    for line in body.split("\n"):
        s = line.strip()
        if not s or _B64_LINE.match(s):
            if cur:
                out.append(" ".join(cur))
                cur = []
            continue
        cur.append(s)
    if cur:
        out.append(" ".join(cur))
    return out
