"""DataFrame operators the models are composed of."""
