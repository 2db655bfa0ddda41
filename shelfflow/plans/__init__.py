"""Multi-step builds: facts, views, forecast to reorder point."""
