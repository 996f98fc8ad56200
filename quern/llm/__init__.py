"""Training-data operators. Import the modules you need; nothing is imported here, so workers stay small."""
