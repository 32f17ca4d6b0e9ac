"""Texts that appear as values in results, kept apart so that they can be exchanged."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Labels:
    weekdays: tuple[str, ...]  # Sunday first
    amount_bands: tuple[str, str, str, str]
    group_bands: tuple[str, str, str, str, str]
    error_rate_bands: tuple[str, str, str, str, str]
    reasons: tuple[str, str, str]  # daily count, cities, daily amount
    levels: tuple[str, str, str, str]  # high, medium, low, very low
    groups: tuple[str, str]  # normal, suspect


ENGLISH = Labels(
    weekdays=("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"),
    amount_bands=("< 10", "10 - 50", "50 - 200", ">= 200"),
    group_bands=("< 10", "10-50", "50-200", "200-500", ">= 500"),
    error_rate_bands=("0%", "0-5%", "5-10%", "10-25%", ">= 25%"),
    reasons=("Too many tx/day", "Many cities", "High amount"),
    levels=("HIGH", "MEDIUM", "LOW", "VERY_LOW"),
    groups=("NORMAL", "SUSPECT"),
)

# The French texts of the original results.
FRENCH = Labels(
    weekdays=("Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi"),
    amount_bands=("< 10 €", "10 - 50 €", "50 - 200 €", ">= 200 €"),
    group_bands=("< 10 €", "10-50 €", "50-200 €", "200-500 €", ">= 500 €"),
    error_rate_bands=("0%", "0-5%", "5-10%", "10-25%", ">= 25%"),
    reasons=("Trop de tx/jour", "Multi-villes", "Montant élevé"),
    levels=("ÉLEVÉ", "MOYEN", "FAIBLE", "TRÈS FAIBLE"),
    groups=("NORMAUX", "SUSPECTS"),
)
