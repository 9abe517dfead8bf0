"""Whole report jobs and the registered queries."""
