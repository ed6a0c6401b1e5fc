"""Run reports and where they go."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame


def report_subject(statuses: list[str], failed: bool = False) -> str:
    """The worst thing first."""
    if failed:
        return "FAILED"
    for status in ("DEAD", "QUIET", "SILENT"):
        if n := statuses.count(status):
            return f"{n} {status}"
    return "OK"


def should_send(failed: bool, send_success: bool = False) -> bool:
    """Failures always, success only if asked for."""
    return failed or send_success


def report_html(counters: dict[str, object], costs: DataFrame | None = None, health: DataFrame | None = None, error: str = "") -> str:
    parts = [f"<h1>{escape(report_subject([r['status'] for r in health.collect()] if health is not None else [], bool(error)))}</h1>"]
    if error:
        parts.append(f"<pre>{escape(error)}</pre>")
    parts.append("<table>" + "".join(f"<tr><td>{escape(str(k))}</td><td>{escape(str(v))}</td></tr>" for k, v in counters.items()) + "</table>")
    for df in (costs, health):
        if df is not None:
            rows = df.collect()
            if rows:
                parts.append("<table><tr>" + "".join(f"<th>{escape(c)}</th>" for c in df.columns) + "</tr>" + "".join("<tr>" + "".join(f"<td>{escape(str(x))}</td>" for x in r) + "</tr>" for r in rows) + "</table>")
    return "".join(parts)


def mail_envelopes(groups: DataFrame, subject: str, html: str) -> list[dict[str, object]]:
    """One message for each group, all recipients blind copies. Sending is the caller's."""
    return [{"to": r["primary"], "bcc": [r["primary"], *r["cc"]], "subject": subject, "html": html} for r in groups.collect()]
