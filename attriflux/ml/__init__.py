"""Training, evaluation and scoring of anomaly and ROAS models."""
