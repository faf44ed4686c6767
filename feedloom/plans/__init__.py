"""End-to-end plans: from topic or file rows to what the sinks take."""
