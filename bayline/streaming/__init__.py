"""Stateless scoring of visits as they arrive, with the functions of the batch jobs."""
