"""Messages, summaries and prompts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions import dates, records
from quern.functions import text as T

# The file of each profile.
PROFILE_FILES = {"ee": "dynamic_resume_ee.txt", "aiml": "dynamic_resume_aiml.txt", "hybrid": "dynamic_resume_hybrid.txt"}


def job_message(text: Column, similarity: Column, score: Column, shortlisted: Column) -> Column:
    """The notification of one shortlisted job, in HTML; all text is escaped but the web address."""
    profile = F.create_map(*[F.lit(x) for pair in PROFILE_FILES.items() for x in pair])[records.choose_profile(text)]
    deadline = records.deadline(text)
    line = F.when(deadline == records.NO_DEADLINE, "📅 Deadline: Not specified").otherwise(F.concat(F.lit("🗓 Apply before: "), deadline))
    return F.concat_ws(
        "\n",
        F.lit("<b>📢 New Job Alert</b>"),
        F.concat(F.lit("<b>🏢 "), T.escape_html(records.employer(text)), F.lit("</b>")),
        F.concat(F.lit("<code>"), T.escape_code(T.preview(text, 160)), F.lit("</code>")),
        F.concat(F.lit("<b>"), line, F.lit("</b>")),
        F.concat(F.lit("<b>🌐</b> "), records.website(text)),
        F.concat(F.lit("<b>🎯 Similarity:</b> "), F.format_string("%.2f", similarity), F.lit(" | <b>Score:</b> "), F.coalesce(score.cast("string"), F.lit("N/A")), F.lit("/5")),
        F.concat(F.lit("<b>📄 Resume:</b> <code>"), T.escape_code(profile), F.lit("</code>")),
        F.concat(F.lit("<b>💼 Resume tip:</b> "), T.escape_html(records.tip(text))),
        F.concat(F.lit("<i>Shortlisted on "), dates.display(shortlisted), F.lit("</i>")),
    )


def summary_message(scanned: Column, sent: Column, failed: Column, seconds: Column, latest: Column, now: Column) -> Column:
    """The daily summary; empty if nothing was new (a null latest text)."""
    body = F.concat_ws(
        "\n",
        F.lit("<b>📊 Daily Summary</b>"),
        F.concat(F.lit("• <b>Jobs scanned:</b> "), scanned.cast("string")),
        F.concat(F.lit("• <b>Sent:</b> "), sent.cast("string"), F.lit(" new")),
        F.concat(F.lit("• <b>Failed:</b> "), failed.cast("string")),
        F.concat(F.lit("• <b>Runtime:</b> "), dates.duration(seconds)),
        F.concat(F.lit("• <b>Latest job:</b> "), T.escape_code(T.preview(latest, 80))),
        F.concat(F.lit("• <b>Notified at:</b> "), F.date_format(now, "dd MMM yyyy, HH:mm")),
    )
    return F.when(latest.isNull(), "").otherwise(body)


def batch_prompt(names: Column, contents: Column) -> Column:
    """Several texts in one prompt, each between marks under its name."""
    parts = F.transform(F.arrays_zip(names.alias("n"), contents.alias("c")), lambda p: F.concat(F.lit("FILE: "), p["n"], F.lit("\n---CONTENT_START---\n"), p["c"], F.lit("\n---CONTENT_END---\n")))
    return F.array_join(parts, "\n")


def prompt_with_attachments(prompt: Column, attachments: Column, longest: int = 2000) -> Column:
    """The prompt followed by attachments (array of struct<name, text>), each cut to `longest` characters."""
    parts = F.transform(attachments, lambda a: F.concat(F.lit("\n\n["), a["name"], F.lit("]\n"), F.substring(a["text"], 1, longest)))
    return F.concat(prompt, F.array_join(parts, ""))


def repository_line(name: Column, description: Column, language: Column, topics: Column, readme: Column) -> Column:
    """One line for a repository; missing parts are left out."""
    return F.concat_ws(" | ", name, F.nullif(description, F.lit("")), language, F.nullif(F.array_join(topics, ", "), F.lit("")), F.nullif(F.substring(readme, 1, 200), F.lit("")))
