"""Names and constants shared by all stages."""

# Label texts, their order, and the thresholds of the compound score.
POSITIVE, NEUTRAL, NEGATIVE = "Positive", "Neutral", "Negative"
LABELS = [POSITIVE, NEUTRAL, NEGATIVE]
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.05
HIGH, PERIPHERAL = "High centrality", "Peripheral"
MODELS = ["VADER", "RoBERTa"]
OVERALL = "Overall"
TOP_LEVEL, REPLY = "Top-level", "Reply"
