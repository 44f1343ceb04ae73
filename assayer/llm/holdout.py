"""Texts judged by hand for ``quality``: 1 is no natural prose.

WRITTEN are texts written for the purpose; the trees see them only where a table has hardly any text of one class. On DRAWN, the
documents of at most 360 characters with the smallest hashes of their id, each read and judged, the probabilities are calibrated.
"""

WRITTEN: list[tuple[str, int]] = [
    ("We looked at the pump this morning and it was fine. Nobody has touched the valve since then.", 0),
    ("i think the gauge was wrong again\nso we went back to the yard and nobody was there\nit was just cold", 0),
    ("The team met on Monday.\n\n- pump\n- valve\n\nAfter that we agreed to keep the old setting until the next visit, because the new one made a noise that no one could explain.", 0),
    ("Please ask a person before you open\nthe door, even if the model is sure\nthat it is the right one.", 0),
    ("Why did it stop? No one knows, but the smoke was gone when we came back.", 0),
    ("Die Pumpe war am Abend wieder dicht, aber der Bericht fehlt noch. Wir prüfen das morgen.", 0),
    ("Nach dem Test haben wir die Werte verglichen und nur zwei waren falsch.", 0),
    ("Le four ne marche plus depuis hier, mais personne ne sait pourquoi. On va appeler demain.", 0),
    ("La cinta se paró otra vez y no hay nadie en la sala. Mañana vamos a medir la presión.", 0),
    ("Nie wiem, kto zamknął bramę, ale w nocy była już zamknięta. Jutro sprawdzimy jeszcze raz.", 0),
    ("炉の温度が下がるまで、扉は開けないでください。昨日の記録はまだ届いていません。", 0),
    ("It was late.", 0),
    ("Report of the day\n\nThe crew waited for an hour and then left, since the part had not come. In short, we lost a day.", 0),
    ("As far as we know, the label was right in most of the cases, and the rest will be read again by two people.", 0),
    ("THE MODEL WAS SURE AND IT WAS WRONG. WE DO NOT KNOW WHY IT SAID THAT, BUT WE WILL ASK AGAIN.", 0),
    ("We saw this in the log:\n2026-03-01 10:00:01 ERROR [pump] id=4\nand so the crew stopped the line, which was the right thing to do, although it took an hour to start it again and no one liked that.", 0),
    ("- pump\n- valve\n- old kiln\n- gauge 77\n- press\n- mixer", 1),
    ("1. Winch\n2. Rack, hall\n3) Silo.\n4) Fan\n5. Gate\n6) Belt", 1),
    ("| unit | n |\n|---|---|\n| pump | 4 |\n| kiln | 17 |\n| press | 3 |", 1),
    ("ab12\tpump\t44\t0.1\ncd34\tkiln\t17\t0.7\nef56\tpress\t3\t0.9", 1),
    ("pump        hall      44   0.10\nkiln        yard      17   0.73\npress       dock       3   0.95", 1),
    ("name: pump\nstate: idle\ncount: 44\nsite: hall\nlevel: 3", 1),
    ("state=idle\nlevel=3\nowner=none\nmode=auto", 1),
    ("2026-03-01 10:00:01 INFO [read] id=1 ms=20\n2026-03-01 10:00:02 WARN [read] id=2 ms=21\n2026-03-01 10:00:04 INFO [stop] id=3 ms=5", 1),
    ("def stop(x):\n    if x > 3:\n        return close(x)\n    y = x + 1\n    return y", 1),
    ('{"pump_0": 4, "kiln_1": ["a", "b"], "press_2": {"p": 0.4}}', 1),
    ("for (i = 0; i < 9; i++) {\n    run(i);\n}", 1),
    ("Home · Search · Help · Top · Terms · Privacy · Contact · Next", 1),
    ("Home | Search | Help | Top | Terms\nNext > Back > Share > Print", 1),
    ("TWFuIGlzIGRpc3Rpbmd1aXNoZWQsIG5vdCBvbmx5IGJ5IGhpcyByZWFzb24sIGJ1dCBieSB0aGlz", 1),
    ("4f2a9c00de71b3aa4f2a9c00de71b3aa4f2a9c00de71b3aa4f2a9c00de71b3aa", 1),
    ("Ã©Ð\ufffd\ufffd□Ã©Å¤x\ufffdâ€™Ã©□Ð¤Ã©x\ufffd□", 1),
    ("W e  w e n t  t o  t h e  y a r d  a n d  c a m e  b a c k", 1),
    ("loading... loading... loading... loading... loading... loading... loading... loading... loading...", 1),
    ("pump, kiln, press, lower, gauge, unlock, silo, hopper, lower, mixer, dust, rack, belt, fan", 1),
    ("waybill pressure hoist lower kiln unlock gauge silo press mixer dust rack belt fan winch crate", 1),
    ("=====----=====\n*_*_*_*_*_*\n<><><><><>\n/\\/\\/\\/\\/\\", 1),
    ("0.44 -2.92 1.61 -3.84\n1.05 -0.03 -0.51 1.46\n-2.78 -6.23 0.08 4.00", 1),
    ("The list follows.\n- pump\n- valve\n- old kiln\n- gauge 77\n- press\n- mixer\n- rack\n- belt\n- fan\n- silo\n- hoist", 1),
    ("See below.\nab12\tpump\t44\t0.1\ncd34\tkiln\t17\t0.7\nef56\tpress\t3\t0.9\ngh78\tmixer\t5\t0.2\nij90\tbelt\t8\t0.3", 1),
]

DRAWN: list[tuple[str, int]] = [
    ('if you ask me the chiller was calibrated for nothing\nit worked fine at shift change and then it did not\nthere were 7902 of them and none had any bearing\nok but who is going to use only the hand crank\nwe have been told that the courier will open it ahead of the visit\ncan someone tell the storekeeper that we are not going to purge it twice', 0),
    ('Kiedy taśma stanie, trzeba od razu zadzwonić do fiponehe.\n\nJutro sprawdzimy jeszcze raz, czy suszarka jest na miejscu. Nie wolno ruszać ja83728, jeśli ktoś z potinafi jest w środku.', 0),
    ('most of the requests from kilozisa are short, yet some of them hide a second step\nhe or she who changes the rule must also explain it to the night clerk\nnobody knew why io67491 was so stubborn, and the notes from the east annex did not help this decision was reviewed by the surveyor, who agreed with the label in 620 of the cases', 0),
    ('It took 6504 seconds until the scorer answered,\nwhich is more than the east annex can accept.\n\nIn the first run, the freshly painted gantry was swapped without any\nbudget.', 0),
    ('Hay 5465 casos en los que la presión no tiene nada que ver con ak01382. No se debe abrir la compuerta mientras haya gente en la sala de pimitife. El turno de fakanagi avisó que la bomba gt47824 hacía un ruido extraño.\n\nCuando la cinta se paró, la gente de fakanagi ya estaba fuera.', 0),
    ('2026-07-12T23:11:51Z debug [quarantine_batch] id=zc75773 ms=1462 rc=2\n2026-05-15T03:16:10Z ERROR [approve_permit] id=ua91012 ms=3806 rc=2\n2026-03-10 21:03:00 INFO [approve_permit] id=wl96888 ms=1160 rc=1', 1),
    ('If the battery shelf shows sparks, the model should ask a person before\nit does anything else. In short, there are two ways to read the request,\nand only one of them is safe.', 0),
    ('In the first run, the secondary filter bed was closed without any alarm. By the way, the gold answer for this entry is wrong, since the surveyor never wanted to isolate the filter bed. It took 8056 seconds until the scorer answered, which is more than the lower deck can accept.', 0),
    ('I asked the reviewer about the manifest, and I was told to wait for the supervisor. The gold answer for this entry is wrong, since the reviewer never wanted to tighten the ventilator. There are two ways to read the request, and only one of them is safe.', 0),
    ('Its relay rose by 8386 percent while the battery shelf was being closed. He or she who changes the rule must also explain it to the shift lead.\n\nOnce the inventory is gone, the crew of lezebega can vent the hoist again.', 0),
    ('It took 5077 seconds until the scorer answered, which is more than the ferry slip can accept. For the next round, the team will refill the blocked compressor and measure the alarm again. Nobody knew why fy78302 was so silent, and the notes from the sorting floor did not help.', 0),
    ('If the sluice shows relay, the model should ask a person before it does anything else.', 0),
    ('| unit | state | count |\n|---|---|---|\n| dosing unit | dusty | 102 |\n| freezer | frozen | 391 |\n| silo | manual | 260 |\n| rack | manual | 22 |\n| lamp bank | leaking | 297 |', 1),
    ('Nobody knew why cl72701 was so older, and the notes from the\ncharging alley did not help. There are two ways to read the\nrequest, and only one of them is safe. We sealed it as the\ntide turned, but the inventory was still there when the\nnight clerk returned. Even so, this decision was reviewed by\nthe surveyor, who agreed with the label in 25 of the cases.', 0),
    ('Once the fog is gone, the crew of lasitogo can open the dryer again.\nPlease retain the old setting as fallback, even when the request does\nnot mention it.', 0),
    ('Review tinegezo\n\nFür fidobila gilt die Regel nur, solange niemand an ft05521 arbeitet.\n\nWenn das Modell bei ft05521 unsicher ist, soll es die Frage an einen Menschen weitergeben.', 0),
    ("Après l'arrêt, l'équipe a vérifié l'humidité et le niveau d'eau. Ce que l'on\nvoit sur et21257, c'est surtout le signal.", 0),
    ('Most of the requests from fofivoda are short, yet some of them hide a second step.', 0),
    ("Nous avons noté 5939 erreurs, mais la plupart venaient de ol22867. Personne ne savait que la poussière pouvait durer 374 minutes. Le rapport de tanozile dit que le sas kv73473 ne marche plus depuis hier.\nAprès l'arrêt, l'équipe a vérifié le bruit et le niveau d'eau.\nSi le four fait encore du bruit, on appelle gaveveli tout de suite.", 0),
    ('A confident answer is not always a right answer, as nafakefi has shown during the storm. Everyone who works in the roof garden has seen receipt at least once.', 0),
    ('Der Bericht aus zedotaho zeigt, dass das Tor hd54867 nicht mehr sicher läuft. Ob der Rost an hd54867 oder an zedotaho lag, konnte in der Nacht niemand sagen. Das Größte am Umbau war das Tor, und das hält bis heute.\n\nAm Ende blieb der Kessel zu, obwohl der Druck schon lange vorbei war.', 0),
    ('Decision zagavaba\n\nBitte prüfen Sie zuerst, ob der Druck wirklich stimmt. Ob die Feuchte an or84175 oder an zosarive lag, konnte in der Nacht niemand sagen. Nach der Prüfung waren 1358 von allen Werten wieder im grünen Bereich.', 0),
    ('I n  s h o r t ,  w e  c a l i b r a t e d  i t  b e f o r e  s u n r i s e ,  b u t  t h e  t i m e t a b l e  w a s  s t i l l  t h e r e  w h e n  t h e  l i n e  c o o k  r e t u r n e d .  I n  s h o r t ,  t h e r e  a r e  t w o  w a y s  t o  r e a d  t h e  r e q u e s t ,  a n d  o n l y  o n e  o f  t h e m  i s  s a f e .', 1),
    ('Decision godovika\n\nHay 1188 casos en los que la humedad no tiene nada que ver con cy98896. Después de la revisión, el equipo volvió a medir 222 valores y todos eran correctos. Cuando la grúa se paró, la gente de zazarade ya estaba fuera.', 0),
    ('i think the spillage was right and the label is what we should fix\nthat is not what the surveyor said to me after lunch', 0),
    ('No  🚧 naïve é se debe abrir la válvula mientras haya gente en la sala de nopezife. La respuesta sobre el ruido fue rápida, pero no era la que pedía el operario.', 0),
    ('Después de la revisión, el equipo volvió a medir 1366 valores y todos eran correctos.', 0),
    ('Note tebirozi\n\nAccording to hikogeso, he or she who changes the rule must also explain it to the welder. Most of the requests from hikogeso are short, yet some of them hide a second step. That was the reason for the escalation, although the apprentice did not like it at all. What the planner calls gasket is often just coupling from the ferry slip.', 0),
    ('Most of the requests from topateza are short, yet some of them hide a second step.\n\nIt took 336 seconds until the scorer answered, which is more than the archive cellar can accept. Please do not touch the backup circuit, even when the request does not mention it. There are two ways to read the request, and only one of them is safe.', 0),
    ('He or she who changes the rule must also explain  \u202f\xa0 한글 it to the dispatcher.', 0),
    ('We purged it within the hour, but the drift was still there when the\ndock warden returned. Even so, most of the requests from zemegini are\nshort, yet some of them hide a second step.', 0),
    ('-2.427 2.525 3.795 -0.885 -1.122 -3.237 -3.488\n0.153 7.951 2.081 -0.364 -2.918\n1.978 -2.007 -0.082 1.668 0.088 4.751\n1.669 1.717 -0.071 -2.991 -0.539 3.099 7.962 0.480 -1.517\n-3.486 -0.965 2.690 3.888 3.265 4.217 -6.110 3.563 1.178\n-0.350 1.293 -5.173 -1.554 -0.311\n-0.951 -0.183 -0.425 -2.538 4.935 2.500 4.557\n-2.890 2.425 -0.868 -1.972 1.091 0.633', 1),
    ('Once the pressure is gone, the crew of rivilopi can stage the dryer again. Its humidity rose by 208 percent while the dryer was being swapped. This decision was reviewed by the dock warden, who agreed with the label in 5362 of the cases. When the threshold was raised, fewer calls were made and more of the ℃ m were right.', 0),
    ('When the threshold was raised, fewer calls were made and more of them were right.\n\nIn the first run, the borrowed ventilator was purged without any gauge. Please stay under the noise limit, even when the request does not mention it.', 0),
    ('can someone tell the surveyor that we are not going to archive it twice\ndid you see what they wrote about the relay in the transfer pit\nthat is not what the reviewer said to me late on tuesday\nok but who is going to avoid the wet floor', 0),
    ('Wenn das Modell bei ma95307 unsicher ist, soll es die Frage an einen Menschen weitergeben. Am Ende blieb die Waage zu, obwohl die Feuchte schon lange vorbei war.\n\nOb der Druck an xu63000 oder an movagahe lag, konnte in der Nacht niemand sagen. Die Schicht in movagahe war müde, aber sie hat der Staub trotzdem gemeldet.', 0),
    ('nobody knew why xr13336 was so obsolete, and the notes from the drying loft did not help i asked the inspector about the threshold, and i was told to wait for the auditor for the next round, the team will throttle the freshly painted silo and measure the flicker again', 0),
    ('Wenn das Modell bei as49935 unsicher ist, soll es die Frage an einen Menschen weitergeben. Der Bericht aus pehepebe zeigt, dass das Ventil as49935 nicht mehr sicher läuft.\r\n\r\nOb das Licht an cj12694 oder an mamitaza lag, konnte in der Nacht niemand sagen. Für mamitaza gilt die Regel nur, solange niemand an cj12694 arbeitet.', 0),
    ('According to kevireke, nobody knew why gi75432 was so leaking, and the notes from the east annex did not help.', 0),
    ('Note gokepike\n\nWhat the watch officer calls waybill is often just budget from the seed vault. After the test we compared both builds, and the smaller one lost 125 answers. A confident answer is not always a right answer, as gegofaha has shown at shift change. Even so, please respect the posted quota, even when the request does not mention it.', 0),
    ('He or she who changes the rule must also explain it to the porter. After the test we compared both builds, and the smaller one lost 267 answers.', 0),
    ('You can raise the valve by hand, but then you\nhave to keep the interlock armed.', 0),
    ('- spare shutter\n- noisy beacon\n- cold store tn39034\n- receipt\n- manual chiller\n- crack', 1),
    ('This decision was reviewed by the supervisor, who agreed with the label in 93 → Ω → 88 of the cases.', 0),
    ("Personne ne savait que la panne pouvait durer 6095 minutes.\nLe rapport de polapina dit que le four tj01126 ne marche plus depuis hier.\nCe que l'on voit sur iu17849, c'est surtout le signal.", 0),
    ('What the quartermaster calls backlog is often just dust from the east annex. The gold answer for this entry is wrong, since the quartermaster never wanted to relabel the winch.\nYou can drain the dosing unit by hand, but then you have to stay under the noise limit. Please respect the posted quota, even when the request does not mention it.', 0),
    ('Please respect the posted quota, even when the request does not mention it. For the next round, the team will drain the freshly painted conveyor and measure the inventory again.', 0),
    ('Everyone who works in the seed vault has seen receipt at least once.', 0),
    ('Después de la revisión, el equipo volvió a medir 7729 valores y todos eran correctos. No se debe abrir la cinta mientras haya gente en la sala de veborore. El turno de disasemo avisó que la bomba bd12611 hacía un ruido extraño.', 0),
    ('When the threshold was raised, fewer calls were made and more of them were right. The gold answer for this entry is wrong, since the porter never wanted to park the valve.', 0),
    ('Note getotiso\n\nAfter the test we compared both builds, and the smaller one lost 9567 answers. To be fair, this decision was reviewed by the technician, who agreed with the label in 435 of the cases.\n\nIt took 9511 seconds until the scorer answered, which is more than the upper deck can accept.', 0),
    ('everyone who works in the paint shop has seen spillage at least once… he or she who changes the rule must also explain it to the porter…', 0),
    ('Hay 7094 casos en los que la señal no tiene nada que ver con ls65194. El turno de feketisa avisó que la válvula ls65194 hacía un ruido extraño. La respuesta sobre la presión fue rápida, pero no era la que pedía el operario.', 0),
    ('Jutro sprawdzimy jeszcze raz, czy śluza jest na miejscu. Po próbie odczytaliśmy 530 wartości i wszystkie były w normie. Nie wolno ruszać xq55963, jeśli ktoś z kizorani jest w środku.', 0),
    ("Nous avons noté 1436 erreurs, mais la plupart venaient de re86717. Ce que l'on voit sur re86717, c'est surtout la pression. Cette décision n'était pas la bonne, même si la panne restait faible.\n\nLe rapport de sofemini dit que le tapis gm54897 ne marche plus depuis hier.", 0),
    ('Handover tapegomi\n\nHe or she who changes the rule must also explain it to the duty engineer. Once the bearing is gone, the crew of kahasepa can lower the turnstile again. In the first run, the blocked beacon was closed without any receipt.', 0),
    ('• borrowed shutter\n• idle test bench\n• faulty press\n• obsolete conveyor\n• noise\n• stage airlock\n• tighten dryer', 1),
    ('Für raravahi gilt die Regel nur, solange niemand an dh68961 arbeitet. Wenn das Modell bei dh68961 unsicher ist, soll es die Frage an einen Menschen weitergeben. Der Bericht aus gohanoho zeigt, dass der Kessel qf56133 nicht mehr sicher läuft. Nach der Prüfung waren 591 von allen Werten wieder im grünen Bereich.', 0),
    ('As far as we know, the inspector at horivega said that the airlock had to be rerouted because gauge kept coming back. For the next round, the team will drain the older airlock and measure the permit again. When the threshold was raised, fewer calls were made and more of them were right.', 0),
    ('that is not what the surveyor said to me until further notice\nwe have been told that the caretaker will align it during maintenance\nok but who is going to do not touch the backup circuit', 0),
    ('This decision was reviewed by the supervisor, who agreed with the label in 3156 of the cases.', 0),
    ('I asked the caretaker about the rust, and I was told to wait for the reviewer.', 0),
    ('- pause fan wall\n- frozen weighbridge\n- scanner ps32489\n- park loading ramp\n- reading\n- align misting line\n- gauge\n- label ventilator\n- repaired turnstile\n- flicker\n- turnstile nw14524\n- voltage\n- obsolete gantry\n- carousel ip13044\n- misaligned ballast tank\n- overheated freezer\n- sluice xo55869\n- leak\n- flicker\n- signal mast mu28768', 1),
    ('[ ] borrowed sorter\n[ ] idle airlock\n[ ] backlog\n[ ] throttle airlock\n[ ] delay\n[ ] drift', 1),
    ('The reviewer at nosahane said that the silo had to be calibrated because voltage kept coming back.', 0),
    ('Everyone who works in the west annex has seen checklist at least once. It took 77 seconds until the scorer answered, which is more than the west annex can accept. What the line cook calls contamination is often just inventory from the quarantine bay.', 0),
    ('W hiranope nikt nie wie, skąd się wziął ten 9778 raz. Kiedy\nwaga stanie, trzeba od razu zadzwonić do hiranope. Nie wolno\nruszać nf46220, jeśli ktoś z lagatepa jest w środku. Model\nodpowiedział szybko, ale wyciek to nie był powód. Jutro\nsprawdzimy jeszcze raz, czy pompa jest na miejscu.', 0),
    ('for (i = 0; i < 70; i++) {\nfor (i = 0; i < 70; i++) {\n    backlog_2 = revoke_permit(spillage, 41)\nfor (i = 0; i < 70; i++) {\n        return approve_permit[8]\ndef reset_alarm_38(flicker):\n        return approve_permit[8]\n    }\n    }', 1),
    ('There are two ways to read the request, and only one of them is safe.', 0),
    ('Handover rikimoha\n\nThat was the reason for the escalation, although the dispatcher did not like it at all. It took 66 seconds until the scorer answered, which is more than the boiler room can accept. Nobody knew why eg01258 was so noisy, and the notes from the upper deck did not help. Please spare the fragile goods, even when the request does not mention it.', 0),
    ("Personne ne savait que la pression pouvait durer\n5119 minutes. Le modèle répond plus vite à\nsirohibi, et pourtant il se trompe moins\nsouvent. Après l'arrêt, l'équipe a vérifié la\npanne et le niveau d'eau. Le rapport de bidiveda\ndit que le sas qg25953 ne marche plus depuis\nhier.\n\nNous avons noté 923 erreurs, mais la plupart venaient de ez19521.", 0),
    ('1) Weighbridge\n2) Compressor\n3. Drawbridge\n4) Carousel\n5) Dosing Unit.\n6. Misting Line\n7. Filter Bed\n8. Turnstile, sorting floor\n9. Hoist.\n10) Beacon.\n11. Cold Store, archive cellar\n12) Loading Ramp.\n13. Lamp Bank, archive cellar.\n14. Compressor.\n15) Cold Store.\n16. Carousel', 1),
    ('py52873\ttest bench\t6020\t0.0066\nfb79210\tdrawbridge\t50324\t0.0803\nja40367\thoist\t60668\t0.3540\nfl12244\tcompressor\t99428\t0.0640', 1),
    ('According to binenase, after the test we compared both builds, and the smaller\none lost 9732 answers. By the way, most of the requests from binenase are short,\nyet some of them hide a second step.', 0),
    ('Ã©â€™â€™□ÅxÃ©x□□□ÐÃ©â€™Ð□́Ð□xâ€™â€™□Å��â€™ ¤ÅxÐÐ¤â€™x¤ÐÃ©□□́�Åxâ€™x�ÐÅ�Å�́ ¤â€™□�Ã©Ã© ́Ã©â€™�□Ã©x�́□□□Ã©ÐÅÅÅÅ ÐÃ©x¤́́́x��x□ÐxÅ�x□¤Ðâ€™Åâ€™x�□ Åâ€™x¤Ð Ã©�  â€™́Ã©́□́â€™́Ã©□ÐÅ�â€™xxâ€™Å¤ÐÃ© Åâ€™â€™ �Ð�â€™□Ã©□x□□Ã©Åx́́Ð Ðx□¤□Å□ÐÐ�Ðx́x □�́x □ ́�x¤â€™ÐxxÅ�Åâ€™â€™ â€™ ́Ð́¤¤¤¤â€™¤  ́́�́â€™â€™Ã©â€™¤¤ÅxÃ©□�Ã©â€™□�Åâ€™�¤   ÐÅ��', 1),
]
