"""Late-delivery risk: chronological split, features, models, evaluation and scoring."""
