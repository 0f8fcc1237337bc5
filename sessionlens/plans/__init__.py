"""Model configurations (fixed values), composed models, query catalogue and oracle SQL."""
