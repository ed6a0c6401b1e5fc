"""The digest as HTML. Selections are small by their caps, so rendering is the driver's; every value is escaped."""

from __future__ import annotations

from html import escape
from typing import Any

from pyspark.sql import DataFrame

MAX_BYTES = 102_000


def _rows(df: DataFrame | None, limit: int) -> list[dict[str, Any]]:
    return [r.asDict(recursive=True) for r in df.limit(limit).collect()] if df is not None else []


def _block(title: str, items: list[str]) -> str:
    """A section, nothing at all without items."""
    return f"<section><h2>{escape(title)}</h2><ul>{''.join(f'<li>{x}</li>' for x in items)}</ul></section>" if items else ""


def _link(url: Any, text: Any) -> str:
    safe = str(url or "")
    safe = safe if safe.startswith(("http://", "https://")) else "#"
    return f'<a href="{escape(safe, quote=True)}">{escape(str(text or ""))}</a>'


def render_digest(
    *, title: str, preheader: str = "", takeaway: str = "", sections: list[tuple[str, str]] | None = None, stories: DataFrame | None = None, radar: DataFrame | None = None, more: int = 0,
    movers: DataFrame | None = None, publications: DataFrame | None = None,
) -> str:
    """Brief, stories, account radar, movers, publications, in this order; empty blocks are left out."""
    parts = ([f"<div style='display:none'>{escape(preheader)}</div>"] if preheader else []) + [f"<h1>{escape(title)}</h1>"]
    if takeaway:
        parts.append(f"<p><strong>{escape(takeaway)}</strong></p>")
    parts += [f"<h3>{escape(a)}</h3><p>{escape(b)}</p>" for a, b in sections or []]
    parts.append(_block("Top stories", [_link(r["url"], r["title"]) + f" <small>{escape(str(r.get('source_name') or ''))}" + (f", {r['size']} sources" if r.get("size", 1) > 1 else "") + "</small>" for r in _rows(stories, 50)]))
    account = [f"<b>{escape(str(r['company_name']))}</b> " + _link(r.get("url"), r["title"]) + f" <small>{r['score']}/5</small>" for r in _rows(radar, 50)]
    if account and more:
        account.append(f"{more} more")
    parts.append(_block("Account radar", account))
    parts.append(_block("Movers", [f"{escape(str(r['name']))} {escape(str(r['crop']))}: {r['value']:,.0f} ({r['yoy_pct']:+.1f}%)" for r in _rows(movers, 50)]))
    parts.append(_block("Publications", [_link(r["url"], r["title"]) for r in _rows(publications, 100)]))
    return "<!DOCTYPE html><html><head><meta charset='utf-8'><title>" + escape(title) + "</title></head><body>" + "".join(parts) + "</body></html>"


def render_matrix(rows: list[dict[str, Any]], crops: list[str]) -> str:
    """A country by crop table with a header wherever the region changes."""
    out, region = ["<table><tr><th></th>" + "".join(f"<th>{escape(c)}</th>" for c in crops) + "</tr>"], object()
    for r in rows:
        if r["region"] != region:
            region = r["region"]
            out.append(f"<tr><th colspan='{len(crops) + 1}'>{escape(str(region))}</th></tr>")
        cells = []
        for c in crops:
            v, y = r.get(f"{c}_value"), r.get(f"{c}_yoy_pct")
            cells.append("<td>" + (f"{v:,.0f}" if v is not None else "–") + (f" <small>{y:+.1f}%</small>" if y is not None else "") + "</td>")
        out.append(f"<tr><td>{escape(str(r['name']))}</td>{''.join(cells)}</tr>")
    return "".join(out) + "</table>"


def render_with_fallback(**parts: Any) -> str:
    """The full digest, or a plain list of the stories if it can't be rendered."""
    try:
        return render_digest(**parts)
    except Exception:  # noqa: BLE001 - the digest goes out in any case
        return "<html><body>" + _block("Top stories", [_link(r.get("url"), r.get("title")) for r in _rows(parts.get("stories"), 50)]) + "</body></html>"
