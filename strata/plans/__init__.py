"""Multi-step plans (the layered pipeline), join helpers and plan inspection."""
