"""Feature stages, model families, training, selection and explanation."""
