"""Rules of the findings: conditions and texts over the facts of a table."""

from __future__ import annotations

from plumbline.operators.findings import Rule

STATISTICS, DATA, STRUCTURE = "Statistics", "Data", "Structure"

CHALLENGES = (
    Rule(
        STATISTICS, "Skewed response", "abs(skewness) >= 0.75",
        "format_string('Skewness of %s is %.4f.', target, skewness)",
        "Try a transformed response and keep it only if held-out error falls.",
    ),
    Rule(
        DATA, "Gaps in predictors", "size(gaps) > 0",
        "concat('Columns with gaps: ', array_join(gaps, ', '), '.')",
        "Learn fill values on training rows and reuse them for every other row.",
    ),
    Rule(
        STATISTICS, "Collinear predictors", "pairs > 0",
        "format_string('Pairs of predictors with |r| of at least 0.80: %d.', pairs)",
        "Check whether coefficients can be told apart; prediction may use both columns.",
    ),
    Rule(
        STATISTICS, "Curved relationships", "size(curved) > 0",
        "concat('Not straight against the response: ', array_join(curved, ', '), '.')",
        "Compare a straight line with polynomial and spline terms on validation rows.",
    ),
    Rule(
        DATA, "Outlying rows", "size(extreme) > 0",
        "concat('Columns with 5 % or more flagged rows: ', array_join(extreme, ', '), '.')",
        "Keep the rows, and refit without them to see how much rests on them.",
    ),
    Rule(
        STRUCTURE, "Location effects", "located", "'Rows carry latitude and longitude.'",
        "Give location joint or regional terms instead of two separate slopes.",
    ),
)

NOTES = (
    Rule(
        "eda", "shape", "true",
        "CASE WHEN skewness > 0.5 THEN concat(target, ' has a long right tail.') "
        "WHEN skewness < -0.5 THEN concat(target, ' has a long left tail.') "
        "ELSE concat(target, ' has no long tail.') END",
    ),
    Rule(
        "eda", "strongest", "strongest.feature IS NOT NULL",
        "format_string('%s follows the target most closely on a straight line (r = %.4f).', strongest.feature, strongest.r)",
    ),
    Rule(
        "eda", "extreme", "size(extreme) > 0",
        "concat('At least 5 % of the rows are flagged in ', array_join(extreme, ', '), '.')",
    ),
    Rule("eda", "gaps", "size(gaps) > 0", "concat('Gaps to be filled from training rows: ', array_join(gaps, ', '), '.')"),
    Rule("eda", "reading", "true", "'Associations here say nothing about causes.'"),
    Rule(
        "understanding", "gaps", "true",
        "CASE WHEN size(gaps) = 0 THEN 'Every column is complete.' "
        "ELSE concat('Incomplete columns: ', array_join(gaps, ', '), '.') END",
    ),
    Rule(
        "understanding", "checks", "true",
        "CASE WHEN size(review) = 0 THEN 'Every logical check passes.' "
        "ELSE concat('Logical checks to look into: ', array_join(review, ', '), '.') END",
    ),
    Rule("understanding", "untouched", "true", "'So far nothing was changed.'"),
    Rule(
        "insight", "size", "observations IS NOT NULL",
        "format_string('%s is known for %,d rows; its mean is %,.2f.', target, observations, mean)",
    ),
    Rule(
        "insight", "skew", "abs(skewness) > 1",
        "format_string('%s is strongly skewed (%.2f).', target, skewness)",
    ),
    Rule(
        "insight", "gap", "true",
        "CASE WHEN widest.column_name IS NULL THEN 'There are no gaps.' "
        "ELSE format_string('%s has the most gaps: %,d rows.', widest.column_name, widest.missing_count) END",
    ),
    Rule(
        "insight", "direction", "r IS NOT NULL",
        "format_string('%s %s with %s (r = %.3f).', target, CASE WHEN r > 0 THEN 'rises' ELSE 'falls' END, feature, r)",
    ),
    Rule(
        "insight", "modal", "modal IS NOT NULL",
        "format_string('The most frequent %s is %s.', category, modal)",
    ),
)
