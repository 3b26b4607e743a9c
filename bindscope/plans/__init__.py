"""End-to-end jobs and the adapter views they run on."""
