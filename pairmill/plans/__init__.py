"""End-to-end plans: corpus preparation, batch answering, evaluation."""
