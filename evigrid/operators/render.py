"""Exported documents as HTML and PDF. Exports are limited to some hundred accounts, so these are written one by one."""

from __future__ import annotations

import html
import textwrap

PAGE_LINES, LINE_LETTERS = 52, 92


def to_html(markdown: str) -> str:
    """Headings, lists and paragraphs of a document as HTML."""
    out, in_list = ["<html><head><meta charset='utf-8'></head><body>"], False
    for line in map(str.strip, markdown.splitlines()):
        if in_list and not line.startswith("- "):
            out.append("</ul>")
            in_list = False
        if line.startswith("- "):
            if not in_list:
                out.append("<ul>")
                in_list = True
            out.append(f"<li>{html.escape(line[2:])}</li>")
        elif line.startswith("#"):
            level = min(len(line) - len(line.lstrip("#")), 6)
            out.append(f"<h{level}>{html.escape(line[level:].strip())}</h{level}>")
        elif line:
            out.append(f"<p>{html.escape(line)}</p>")
    return "\n".join([*out, *(["</ul>"] if in_list else []), "</body></html>"])


def to_pdf(markdown: str) -> bytes:
    """A plain PDF: headings in bold, lines wrapped, as many pages as it takes; signs beyond Latin-1 become question marks."""
    lines: list[tuple[bool, str]] = []
    for raw in markdown.splitlines():
        heading = raw.startswith("#")
        lines += [(heading, part) for part in textwrap.wrap(raw.lstrip("# ").rstrip() if heading else raw.rstrip(), LINE_LETTERS) or [""]]
    pages = [lines[i : i + PAGE_LINES] for i in range(0, max(len(lines), 1), PAGE_LINES)]
    objects: list[bytes] = [b"<< /Type /Catalog /Pages 2 0 R >>", b""]
    objects += [b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>", b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica-Bold /Encoding /WinAnsiEncoding >>"]
    kids = []
    for page in pages:
        text = ["BT 50 760 Td 14 TL"]
        for heading, line in page:
            safe = line.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)")
            text.append(f"/F{2 if heading else 1} {12 if heading else 10} Tf ({safe}) Tj T*")
        body = "\n".join([*text, "ET"]).encode("latin-1", "replace")
        objects.append(b"<< /Length %d >>\nstream\n%s\nendstream" % (len(body), body))
        kids.append(len(objects) + 1)
        objects.append(b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 612 792] /Resources << /Font << /F1 3 0 R /F2 4 0 R >> >> /Contents %d 0 R >>" % len(objects))
    objects[1] = b"<< /Type /Pages /Kids [%s] /Count %d >>" % (b" ".join(b"%d 0 R" % k for k in kids), len(kids))
    out, places = bytearray(b"%PDF-1.4\n"), []
    for i, body in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (i, body)
    start = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
    return bytes(out + b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, start))
